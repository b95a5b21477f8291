from decimal import Decimal

from pyspark.sql import Row

from newsmart import operators as op
from newsmart.schemas import EVENT_FIELDS, EVENT_SCHEMA, GKG_SCHEMA, MENTION_SCHEMA


def _lines(spark, *records):
    return spark.createDataFrame([("\t".join(r),) for r in records], "line string")


def _event(**fields):
    values = {name: "" for name, _ in EVENT_FIELDS} | {"GLOBALEVENTID": "1", "SOURCEURL": "http://x"} | fields
    return [values[name] for name, _ in EVENT_FIELDS]


def _schema(df):
    return [(f.name, f.dataType) for f in df.schema]


def test_schemas(spark):
    lines = _lines(spark, ["x"])
    assert _schema(op.parse_events(lines)) == [(f.name, f.dataType) for f in EVENT_SCHEMA]
    assert _schema(op.parse_mentions(lines)) == [(f.name, f.dataType) for f in MENTION_SCHEMA]
    assert _schema(op.parse_gkg(lines)) == [(f.name, f.dataType) for f in GKG_SCHEMA]
    assert len(EVENT_SCHEMA) == 61 and EVENT_SCHEMA.names[53] == "ActionGeo_CountryCode"


def test_events(spark):
    good = _event(SQLDATE="20190101", NumMentions="abc", AvgTone="-1.5", DATEADDED="20190101000000")
    lines = _lines(spark, good, _event(SOURCEURL=""), _event() + ["x"], _event() + ["", ""], [""], _event()[:59])
    rows = op.parse_events(lines).collect()
    assert len(rows) == 2  # closing empty fields do not count, so one of the long lines is well formed
    row = rows[0]
    assert (row.GLOBALEVENTID, row.SQLDATE, row.NumMentions, row.AvgTone) == (1, "20190101", 0, -1.5)
    assert row.Actor1Geo_Lat == 0.0 and row.DATEADDED == Decimal(20190101000000)
    rejected = sorted(r.n_fields for r in op.rejected_lines(lines, "export").collect())
    assert rejected == [1, 1, 1, 62]


def test_numbers_are_never_null(spark):
    row = op.parse_events(_lines(spark, _event())).collect()[0]
    assert None not in row


def test_mentions(spark):
    base = ["1", "20190101000000", "20190102000000", "1", "s", "u", "3", "-1", "-1", "-1", "1", "90", "500", "1.25"]
    rows = op.parse_mentions(_lines(
        spark, base, base + ["srclc:fra;eng:x"], base[:12] + ["500"], base[:13] + ["", "abc"], base + [";"])).collect()
    assert [r.SRCLC for r in rows] == ["", "fra", "abc", ""]
    assert rows[0].MentionDocTranslationInfo == "" and rows[0].Confidence == 90
    assert [r.MentionDocTone for r in rows] == [1.25, 1.25, 0.0, 1.25]


def test_gkg(spark):
    base = ["id", "20190101000000"] + [f"v{i}" for i in range(2, 24)]
    rows = op.parse_gkg(_lines(spark, base + ["am"], base + [""], base + ["", "late"])).collect()
    assert [(r.Amounts, r.SourceCollectionIdentifier) for r in rows] == [("am", 0), ("", 0)]
    assert rows[0].DATE == 20190101000000 and rows[0].TranslationInfo == "" and rows[0].Extras == ""


def test_carried_columns(spark):
    lines = _lines(spark, _event()).selectExpr("line", "'20190101' AS day")
    assert op.parse_events(lines, keep=("day",)).select("day", "GLOBALEVENTID").collect() == [
        Row(day="20190101", GLOBALEVENTID=1)]
