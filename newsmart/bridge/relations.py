"""The rules of ``bridge.feed`` as SQL over the star-schema tables, and each query's result in SQL.

Nothing here goes through feed lines: the expected results are computed from the tables' own columns.
"""

from __future__ import annotations

# The columns of the three records in their order, with their kinds (s text, i and l whole, d double).
_EVENT_COLUMNS = """
GLOBALEVENTID i, SQLDATE s, MonthYear i, Year i, FractionDate d,
Actor1Code s, Actor1Name s, Actor1CountryCode s, Actor1KnownGroupCode s, Actor1EthnicCode s, Actor1Religion1Code s,
Actor1Religion2Code s, Actor1Type1Code s, Actor1Type2Code s, Actor1Type3Code s,
Actor2Code s, Actor2Name s, Actor2CountryCode s, Actor2KnownGroupCode s, Actor2EthnicCode s, Actor2Religion1Code s,
Actor2Religion2Code s, Actor2Type1Code s, Actor2Type2Code s, Actor2Type3Code s,
IsRootEvent i, EventCode s, EventBaseCode s, EventRootCode s, QuadClass i, GoldsteinScale d,
NumMentions i, NumSources i, NumArticles i, AvgTone d,
Actor1Geo_Type i, Actor1Geo_FullName s, Actor1Geo_CountryCode s, Actor1Geo_ADM1Code s, Actor1Geo_ADM2Code s,
Actor1Geo_Lat d, Actor1Geo_Long d, Actor1Geo_FeatureID s,
Actor2Geo_Type i, Actor2Geo_FullName s, Actor2Geo_CountryCode s, Actor2Geo_ADM1Code s, Actor2Geo_ADM2Code s,
Actor2Geo_Lat d, Actor2Geo_Long d, Actor2Geo_FeatureID s,
ActionGeo_Type i, ActionGeo_FullName s, ActionGeo_CountryCode s, ActionGeo_ADM1Code s, ActionGeo_ADM2Code s,
ActionGeo_Lat d, ActionGeo_Long d, ActionGeo_FeatureID s, DATEADDED l, SOURCEURL s
"""
_MENTION_COLUMNS = """
GLOBALEVENTID i, EventTimeDate l, MentionTimeDate l, MentionType i, MentionSourceName s, MentionIdentifier s, SentenceID i,
Actor1CharOffset i, Actor2CharOffset i, ActionCharOffset i, InRawText i, Confidence i, MentionDocLen i, MentionDocTone d,
MentionDocTranslationInfo s
"""
_GKG_COLUMNS = """
GKGRECORDID s, DATE l, SourceCollectionIdentifier i, SourceCommonName s, DocumentIdentifier s, Counts s, V2Counts s,
Themes s, V2Themes s, Locations s, V2Locations s, Persons s, V2Persons s, Organizations s, V2Organizations s, V2Tone s,
Dates s, GCAM s, SharingImage s, RelatedImages s, SocialImageEmbeds s, SocialVideoEmbeds s, Quotations s, AllNames s,
Amounts s
"""


def _record(columns: str, rules: dict[str, str]) -> str:
    """Select list of a record: its rule where a column has one, else the value that tells the field's place."""
    filler = {"s": "'f{0}-' || (id % 7)", "i": "id % 1000 + {0}", "l": "id % 1000 + {0}", "d": "id % 100 + {0} + 0.5::DOUBLE"}
    named = (column.split() for column in columns.strip().split(","))
    return ", ".join(f"{rules.get(name, filler[kind].format(at))} AS {name}" for at, (name, kind) in enumerate(named))


# Parsed events (evt), mentions (men) and articles (art).
_EVT = """
evt0 AS (
  SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d') AS d,
         CASE WHEN o_custkey % 31 = 0 THEN '' ELSE 'NATION_' || (o_custkey % 25) END AS country,
         'NATION_' || (o_orderkey % 25) AS actor_country,
         o_custkey AS cust, o_totalprice AS price
  FROM orders WHERE o_orderkey % 89 <> 1 AND o_orderkey % 83 <> 2),
evt AS (
  SELECT * FROM evt0
  UNION ALL SELECT * FROM evt0 WHERE id % 97 = 0
  UNION ALL SELECT * FROM evt0 WHERE id % 97 = 0)
"""
_MEN = """
men AS (
  SELECT l_orderkey AS id, CAST(strftime(l_shipdate, '%Y%m%d%H%M%S') AS BIGINT) AS t,
         'http://m/' || l_partkey AS url, l_linenumber AS sentence,
         CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS confidence,
         l_discount AS tone, l_suppkey AS supp,
         CASE WHEN l_suppkey % 13 = 0 THEN '' WHEN l_returnflag = 'N' THEN '' WHEN l_returnflag = 'A' THEN 'a'
              WHEN l_linestatus = 'F' THEN 'r:f' ELSE 'abc' END AS lang,
         CASE WHEN l_suppkey % 13 = 0 THEN ';' WHEN l_returnflag = 'N' THEN '' WHEN l_returnflag = 'A' THEN 'srclc:a;eng:m'
              WHEN l_linestatus = 'F' THEN 'srclc:r:f;eng:m' ELSE 'abc' END AS info
  FROM lineitem WHERE l_partkey % 61 <> 0)
"""
_ART = """
art AS (
  SELECT event_id AS id, user_id AS u, event_type AS source,
         CASE WHEN event_id % 59 = 0 THEN '0'
              ELSE strftime(CAST(ts AS DATE) + to_months(CAST(user_id % 12 AS INTEGER)), '%Y%m%d') END AS d,
         CASE WHEN event_id % 59 = 0 THEN 0
              ELSE CAST(strftime(CAST(ts AS DATE) + to_months(CAST(user_id % 12 AS INTEGER)), '%Y%m%d')
                        || strftime(ts, '%H%M%S') AS BIGINT) END AS stamp,
         CASE WHEN event_id % 29 = 0 OR event_id % 31 = 0 THEN NULL
              ELSE CAST(round(value * 100) AS BIGINT) END AS tone
  FROM events WHERE event_id % 53 <> 0)
"""
_LOC = """
loc0 AS (
  SELECT id, 0 AS pos, 'NATION_' || (id % 25) AS name FROM art WHERE id % 37 <> 0
  UNION ALL SELECT id, 1, 'NATION_' || (u % 25) FROM art WHERE id % 37 <> 0
  UNION ALL SELECT id, 2, 'NATION_' || ((id // 25) % 25) FROM art WHERE id % 37 <> 0
  UNION ALL SELECT id, 3, '' FROM art WHERE id % 37 <> 0 AND id % 43 = 0),
loc1 AS (SELECT id, name, min(pos) AS pos FROM loc0 GROUP BY id, name),
loc AS (SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS pos FROM loc1)
"""
_PAIR = """
pair AS (
  SELECT a.id, a.pos AS pos1, b.pos AS pos2, least(a.name, b.name) AS country1, greatest(a.name, b.name) AS country2
  FROM loc a JOIN loc b ON a.id = b.id AND a.pos < b.pos)
"""
_BEST = """
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY confidence DESC, t, url, sentence, lang) AS rn FROM men) WHERE rn = 1)
"""
_A = """
mart_a AS (
  SELECT evt.d AS sqldate, evt.country, best.lang AS language, count(*) AS count
  FROM evt LEFT JOIN best ON evt.id = best.id GROUP BY 1, 2, 3)
"""
_B = """
mart_b AS (
  SELECT e.id AS globaleventid, e.d AS sqldate, c.copies * greatest(coalesce(m.n, 0), 1) AS count,
         coalesce(m.n, 0) AS true_mentions, e.country, CAST(substr(e.d, 1, 4) AS INTEGER) AS year,
         substr(e.d, 5, 2) AS month, substr(e.d, 7, 2) AS day
  FROM evt e JOIN (SELECT id, count(*) AS copies FROM evt GROUP BY id) c ON e.id = c.id
  LEFT JOIN (SELECT id, count(*) AS n FROM men GROUP BY id) m ON e.id = m.id)
"""
_D = """
mart_d AS (
  SELECT substr(d, 7, 2) AS day, substr(d, 5, 2) AS month, substr(d, 1, 4) AS year,
         count(tone) AS n_articles, CAST(sum(tone) AS DOUBLE) / count(tone) AS mean_tone,
         CAST(sum(tone) AS DOUBLE) AS tone_sum, country1, country2
  FROM pair JOIN art ON pair.id = art.id GROUP BY d, country1, country2)
"""
_D_STORED = """
mart_d_stored AS (
  SELECT TRY_CAST(day AS INTEGER) AS day, TRY_CAST(month AS INTEGER) AS month, CAST(year AS INTEGER) AS year,
         CAST(n_articles AS INTEGER) AS n_articles, CAST(mean_tone AS FLOAT) AS mean_tone, country1, country2
  FROM mart_d)
"""
_FILES = """
files AS (
  SELECT CAST(o_orderkey % 1000 + 100 AS BIGINT) AS size,
         strftime(o_orderdate, '%Y%m%d') || CASE WHEN o_orderkey < 1000000 THEN lpad(CAST(o_orderkey AS VARCHAR), 6, '0')
           ELSE substr(CAST(o_orderkey AS VARCHAR), 1, 6) END || '.export.CSV.zip' AS name, o_orderkey AS k
  FROM orders),
translated AS (
  SELECT CAST(event_id % 1000 + 100 AS BIGINT) AS size,
         strftime(ts, '%Y%m%d%H%M%S') || '.translation.gkg.csv.zip' AS name
  FROM events)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(part.strip() + "\n" for part in parts)


_WITH_A = _with(_EVT, _MEN, _BEST, _A)
_WITH_B = _with(_EVT, _MEN, _B)
_WITH_D = _with(_ART, _LOC, _PAIR, _D)
_WITH_DS = _with(_ART, _LOC, _PAIR, _D, _D_STORED)


def _item_mart(select_items: str) -> str:
    """Mart C over rows (id, item)."""
    return f"""item AS ({select_items}),
mart_c AS (
  SELECT d AS date, substr(d, 1, 4) AS year, substr(d, 5, 6) AS month, substr(d, 7, 8) AS day, source, item,
         count(*) AS nbarticle, CAST(sum(tone) AS DOUBLE) / count(*) AS tonemean
  FROM item JOIN art ON item.id = art.id WHERE tone IS NOT NULL GROUP BY d, source, item)"""


_THEMES = _item_mart("""
  SELECT id, '' AS item FROM art
  UNION ALL SELECT id, 'T' || (id % 7) FROM art WHERE id % 13 <> 0
  UNION ALL SELECT id, 'P' || (id % 11) FROM art WHERE id % 13 <> 0""")
_PERSONS = _item_mart("""
  SELECT id, 'p' || (u % 17) AS item FROM art UNION ALL SELECT id, 'q' || (id % 5) FROM art""")
_COUNTRIES = _item_mart("SELECT id, name AS item FROM loc")


def _item_columns(item: str) -> str:
    return f"date, year, month, day, source, item AS {item}, nbarticle, tonemean"


def _excluded(pairs) -> str:
    return " AND ".join(f"NOT (country1 = '{a}' AND country2 = '{b}')" for a, b in pairs)


def _in_watchlist(watchlist) -> str:
    names = sorted(watchlist)
    firsts, seconds = (", ".join(f"'{name}'" for name in part) for part in (names[:-1], names[1:]))
    return f"country1 IN ({firsts}) AND country2 IN ({seconds})"


def _grid(watchlist, excluded, months) -> str:
    names = sorted(watchlist)
    values = ", ".join(f"('{a}', '{b}')" for a in names[:-1] for b in names[1:])
    cells = ",\n".join(
        f"""coalesce(max(CASE WHEN month = {m} THEN bucket END), 5) AS bucket_{m},
        coalesce(max(CASE WHEN month = {m} THEN size END), 0) AS size_{m},
        coalesce(max(CASE WHEN month = {m} THEN mean_tone END), 0.0) AS mean_tone_{m},
        coalesce(max(CASE WHEN month = {m} THEN n_articles END), 0) AS n_articles_{m}"""
        for m in months)
    return _WITH_DS + f""",
monthly AS (
  SELECT country1, country2, month, CAST(sum(CAST(CAST(mean_tone AS DOUBLE) AS DECIMAL(38,12))) AS DOUBLE) / count(mean_tone) AS mean_tone,
         CAST(sum(n_articles) AS BIGINT) AS n_articles
  FROM mart_d_stored WHERE {_excluded(excluded)} AND {_in_watchlist(watchlist)} GROUP BY 1, 2, 3),
spread AS (SELECT min(mean_tone) AS low, max(mean_tone) - min(mean_tone) AS tone_range,
                  max(n_articles) - min(n_articles) AS article_range FROM monthly),
shaded AS (
  SELECT country1, country2, month, mean_tone, n_articles,
         CAST(trunc((mean_tone - low) / nullif(tone_range, 0) * 9) AS INTEGER) AS bucket,
         CAST(trunc(CAST(n_articles AS DOUBLE) / nullif(article_range, 0) * 100) AS INTEGER) AS size
  FROM monthly, spread),
cells (country1, country2) AS (VALUES {values})
SELECT cells.country1, cells.country2, {cells}
FROM cells LEFT JOIN shaded ON cells.country1 = shaded.country1 AND cells.country2 = shaded.country2
GROUP BY cells.country1, cells.country2"""


def expected(day: str, country: str, series: tuple[str, str], pair: tuple[str, str], theme: str, period: str,
             watchlist: tuple[str, ...], excluded: tuple[tuple[str, str], ...], months: tuple[int, ...],
             manifest_period: str) -> dict[str, str]:
    """SQL of every query, by its key; the arguments are those the queries are run with."""
    day_rows = f"SELECT * FROM mart_a WHERE sqldate = '{day}'"
    by_count = "ORDER BY count DESC NULLS LAST, country NULLS FIRST, language NULLS FIRST"
    low, high = (bound.replace("-", "") for bound in series)
    url = "'http://feed.example/v2/' || name"
    return {
        # records
        "parse_events": _with(_EVT) + "SELECT " + _record(_EVENT_COLUMNS, {
            "GLOBALEVENTID": "id", "SQLDATE": "d", "MonthYear": "CAST(substr(d, 1, 6) AS INTEGER)",
            "Year": "CAST(substr(d, 1, 4) AS INTEGER)", "FractionDate": "CASE WHEN id % 3 = 0 THEN 0.0 ELSE price END",
            "Actor1Code": "'A' || (cust % 10)", "IsRootEvent": "1",
            "NumMentions": "CASE WHEN id % 7 = 3 THEN 0 ELSE cust END",
            "NumSources": "CASE WHEN id % 7 = 4 THEN 0 ELSE 5 END",
            "AvgTone": "CASE WHEN id % 11 = 5 THEN 0.0 ELSE price END",
            "Actor1Geo_CountryCode": "actor_country", "ActionGeo_CountryCode": "country",
            "ActionGeo_Lat": "CASE WHEN id % 5 = 0 THEN 0.0 ELSE price END",
            "DATEADDED": "CASE WHEN id % 13 = 6 THEN 0 ELSE CAST(d || '000000' AS BIGINT) END",
            "SOURCEURL": "'http://e/' || id"}) + " FROM evt",
        "parse_mentions": _with(_MEN) + "SELECT " + _record(_MENTION_COLUMNS, {
            "GLOBALEVENTID": "id", "EventTimeDate": "t", "MentionTimeDate": "t", "MentionType": "1",
            "MentionSourceName": "'S' || (supp % 20)", "MentionIdentifier": "url", "SentenceID": "sentence",
            "Confidence": "confidence", "MentionDocLen": "100", "MentionDocTone": "tone",
            "MentionDocTranslationInfo": "info"}) + ", '' AS Extras, lang AS SRCLC, '' AS ENG FROM men",
        "parse_gkg": _with(_ART, _LOC) + "SELECT " + _record(_GKG_COLUMNS, {
            "GKGRECORDID": "CAST(id AS VARCHAR)", "DATE": "stamp", "SourceCollectionIdentifier": "1",
            "SourceCommonName": "source", "DocumentIdentifier": "'http://d/' || id",
            "Themes": "CASE WHEN id % 13 = 0 THEN '' ELSE 'T' || (id % 7) || ';P' || (id % 11) || ';' END",
            "V2Locations": """CASE WHEN id % 37 = 0 THEN '' ELSE '1#NATION_' || (id % 25) || '#A#x;4#City, Region, NATION_'
                || (u % 25) || '#B#x;2#State, NATION_' || ((id // 25) % 25) || '#C#x'
                || CASE WHEN id % 41 = 0 THEN ';4##' ELSE '' END || CASE WHEN id % 43 = 0 THEN ';1# #US#x' ELSE '' END
                END""",
            "Persons": "'p' || (u % 17) || ';q' || (id % 5)",
            "V2Tone": """CASE WHEN id % 31 = 0 THEN '' WHEN id % 29 = 0 THEN 'x,1,2,3,4,5,6'
                ELSE CAST(tone AS VARCHAR) || ',1,2,3,4,5,6' END""",
            "Amounts": "'1'"}) + ", '' AS TranslationInfo, '' AS Extras FROM art",
        "reject_counts": """
            SELECT 'export' AS kind, CASE WHEN o_orderkey % 83 = 2 THEN 62 ELSE 60 END AS n_fields,
                   CAST(sum(CASE WHEN o_orderkey % 97 = 0 THEN 3 ELSE 1 END) AS BIGINT) AS lines
            FROM orders WHERE o_orderkey % 89 = 1 OR o_orderkey % 83 = 2 GROUP BY 1, 2
            UNION ALL
            SELECT 'mentions', 13, count(*) FROM lineitem WHERE l_partkey % 61 = 0 HAVING count(*) > 0
            UNION ALL
            SELECT 'gkg', 24, count(*)
            FROM events WHERE event_id % 53 = 0 HAVING count(*) > 0""",
        "lenient_cast": """
            SELECT l_orderkey, l_linenumber, l_partkey,
              CASE l_partkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 0 WHEN 4 THEN l_partkey
                ELSE -l_partkey END AS as_int,
              CASE l_partkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN l_partkey + 30000000000
                WHEN 4 THEN l_partkey ELSE -l_partkey END AS as_long,
              CASE l_partkey % 6 WHEN 0 THEN 0.0 WHEN 1 THEN l_partkey WHEN 2 THEN l_quantity
                WHEN 3 THEN l_partkey + 30000000000 WHEN 4 THEN l_partkey ELSE -l_partkey END::DOUBLE AS as_double
            FROM lineitem""",
        "source_language": _with(_MEN) + "SELECT lang AS language, count(*) AS mentions FROM men GROUP BY 1",
        "date_parts": _with(_EVT) + """
            SELECT substr(d, 1, 4) AS year, substr(d, 5, 2) AS month, substr(d, 7, 2) AS day, count(*) AS events
            FROM evt GROUP BY 1, 2, 3""",
        "tone_value": _with(_ART) + """
            SELECT CAST(id AS VARCHAR) AS GKGRECORDID, CAST(tone AS DOUBLE) AS tone,
                   CAST(CAST(tone AS FLOAT) AS DOUBLE) AS tone_float FROM art""",
        "location_countries": _with(_ART, _LOC) + """
            SELECT CAST(id AS VARCHAR) AS GKGRECORDID, pos AS position, name AS country FROM loc""",
        "location_pairs": _with(_ART, _LOC, _PAIR) + """
            SELECT CAST(id AS VARCHAR) AS GKGRECORDID, country1, country2 FROM pair""",
        # sources
        "period_prune": _with(_EVT) + f"""
            SELECT d AS SQLDATE, country AS ActionGeo_CountryCode, count(*) AS events
            FROM evt WHERE d LIKE '{period}%' GROUP BY 1, 2""",
        "manifest_filter": _with(_FILES) + f"""
            SELECT size, {url} AS url, name FROM files WHERE name LIKE '{manifest_period}%'""",
        "manifest_union": _with(_FILES) + f"""
            SELECT size, {url} AS url, name FROM files UNION ALL SELECT size, {url}, name FROM translated""",
        "landing_reconcile": _with(_FILES) + """
            SELECT name, size AS expected, CASE WHEN k % 10 <> 0 THEN size - CASE WHEN k % 19 = 0 THEN 1 ELSE 0 END END
                     AS bytes,
                   CASE WHEN k % 10 = 0 THEN 'missing' WHEN k % 19 = 0 THEN 'corrupt' ELSE 'ready' END AS status
            FROM files""",
        # marts
        "best_mention": _with(_MEN, _BEST) + """
            SELECT id AS GLOBALEVENTID, t AS MentionTimeDate, url AS MentionIdentifier, sentence AS SentenceID,
                   confidence AS Confidence, lang AS SRCLC FROM best""",
        "a_language_counts": _WITH_A + "SELECT * FROM mart_a",
        "b_event_mentions": _WITH_B + "SELECT * FROM mart_b",
        "b_rollup": _WITH_B + """
            SELECT country, year, month, day, CAST(count(*) AS BIGINT) AS events, CAST(sum(count) AS BIGINT) AS mentions,
                   CASE WHEN grouping(month) = 1 THEN 'year' WHEN grouping(day) = 1 THEN 'month' ELSE 'day' END AS level
            FROM mart_b GROUP BY GROUPING SETS ((country, year, month, day), (country, year, month), (country, year))""",
        "c_theme": _with(_ART, _THEMES) + f"SELECT {_item_columns('theme')} FROM mart_c",
        "c_person": _with(_ART, _PERSONS) + f"SELECT {_item_columns('person')} FROM mart_c",
        "c_country": _with(_ART, _LOC, _COUNTRIES) + f"SELECT {_item_columns('country')} FROM mart_c",
        "c_items": "UNION ALL ".join(f"(SELECT '{kind}' AS kind, * FROM ({_with(_ART, *parts)} SELECT {_item_columns('item')} FROM mart_c))"
                                     for kind, parts in (("theme", (_THEMES,)), ("person", (_PERSONS,)),
                                                         ("country", (_LOC, _COUNTRIES)))),
        "d_country_pairs": _WITH_D + "SELECT * FROM mart_d",
        "d_monthly": _WITH_D + """
            SELECT country1, country2, month, CAST(sum(CAST(mean_tone AS DECIMAL(38,12))) AS DOUBLE) / count(mean_tone) AS mean_tone,
                   CAST(sum(n_articles) AS BIGINT) AS n_articles,
                   sum(tone_sum) / nullif(sum(n_articles), 0) AS weighted_tone
            FROM mart_d GROUP BY 1, 2, 3""",
        "d_monthly_states": _WITH_D + """
            SELECT country1, country2, month,
                   CAST(sum(CAST(mean_tone AS DECIMAL(38,12))) AS DOUBLE) / count(mean_tone) AS mean_tone,
                   CAST(sum(n_articles) AS BIGINT) AS n_articles
            FROM mart_d GROUP BY 1, 2, 3""",
        "mart_counts": _with(_EVT, _MEN, _BEST, _A, _B, _ART, _LOC, _PAIR, _D, *(
            part.replace("item AS", f"{name}_item AS").replace("mart_c AS", f"mart_{name} AS")
            .replace("FROM item JOIN art ON item.id", f"FROM {name}_item AS item JOIN art ON item.id")
            for name, part in (("theme", _THEMES), ("person", _PERSONS), ("country", _COUNTRIES)))) + """
            SELECT 'querya' AS mart, count(*) AS rows FROM mart_a UNION ALL SELECT 'queryb2', count(*) FROM mart_b
            UNION ALL SELECT 'queryd2', count(*) FROM mart_d UNION ALL SELECT 'queryctheme', count(*) FROM mart_theme
            UNION ALL SELECT 'querycperson', count(*) FROM mart_person
            UNION ALL SELECT 'queryccountry', count(*) FROM mart_country""",
        "mart_schema": _WITH_DS + "SELECT * REPLACE (CAST(mean_tone AS DOUBLE) AS mean_tone) FROM mart_d_stored",
        "collapse_to_key": _WITH_A + """
            SELECT sqldate, country, count, max(language) AS language FROM mart_a GROUP BY 1, 2, 3""",
        # serving
        "serve_a_day": _WITH_A + day_rows,
        "serve_a_topk": _WITH_A + f"{day_rows} {by_count} LIMIT 10",
        "serve_a_topk_skip": _WITH_A + f"{day_rows} {by_count} LIMIT 5 OFFSET 1",
        "serve_a_choropleth": _WITH_A + f"""
            SELECT country, count AS number_events FROM ({day_rows} {by_count} OFFSET 1)""",
        "serve_a_country": _WITH_A + f"SELECT * FROM mart_a WHERE country = '{country}'",
        "serve_a_series": _WITH_A + f"""
            SELECT *, strftime(strptime(sqldate, '%Y%m%d'), '%Y-%m-%d') AS day FROM mart_a
            WHERE country = '{country}' AND sqldate >= '{low}' AND sqldate < '{high}'""",
        "serve_b_country": _WITH_B + f"SELECT * FROM mart_b WHERE country = '{country}'",
        "serve_c_item": _with(_ART, _THEMES)
            + f"SELECT {_item_columns('theme')} FROM mart_c WHERE item = '{theme}'",
        "serve_d_pair": _WITH_D
            + f"SELECT * FROM mart_d WHERE country1 = '{pair[0]}' AND country2 = '{pair[1]}'",
        "d_monthly_top": _WITH_D + f"""
            SELECT country1, country2, month, CAST(sum(CAST(mean_tone AS DECIMAL(38,12))) AS DOUBLE) / count(mean_tone) AS mean_tone,
                   CAST(sum(n_articles) AS BIGINT) AS n_articles,
                   sum(tone_sum) / nullif(sum(n_articles), 0) AS weighted_tone
            FROM mart_d WHERE {_excluded(excluded)} GROUP BY 1, 2, 3""",
        "pair_exclude_alias": _WITH_D + f"SELECT * FROM mart_d WHERE {_excluded(excluded)}",
        "pair_watchlist": _WITH_D + f"SELECT * FROM mart_d WHERE {_in_watchlist(watchlist)}",
        "pair_grid": _grid(watchlist, excluded, months),
        "sql_events_per_day": _with(_EVT) + "SELECT d AS SQLDATE, count(*) AS nbEvents FROM evt GROUP BY 1",
        "sql_events_sorted": _with(_EVT)
            + "SELECT d AS SQLDATE, actor_country AS Actor1Geo_CountryCode, id AS GLOBALEVENTID FROM evt ORDER BY 1 DESC",
    }
