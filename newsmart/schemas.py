"""Record layouts of the feed and the six mart schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: field names and kinds of the feed's record layouts, in field order. -------------------------
# s = text, i = int, l = long, d = double, n = 38-digit whole number

_ACTOR = (
    "Code", "Name", "CountryCode", "KnownGroupCode", "EthnicCode", "Religion1Code", "Religion2Code",
    "Type1Code", "Type2Code", "Type3Code",
)
_GEO = (
    ("Type", "i"), ("FullName", "s"), ("CountryCode", "s"), ("ADM1Code", "s"), ("ADM2Code", "s"),
    ("Lat", "d"), ("Long", "d"), ("FeatureID", "s"),
)

EVENT_FIELDS: tuple[tuple[str, str], ...] = (
    ("GLOBALEVENTID", "i"), ("SQLDATE", "s"), ("MonthYear", "i"), ("Year", "i"), ("FractionDate", "d"),
    *((f"Actor1{part}", "s") for part in _ACTOR),
    *((f"Actor2{part}", "s") for part in _ACTOR),
    ("IsRootEvent", "i"), ("EventCode", "s"), ("EventBaseCode", "s"), ("EventRootCode", "s"), ("QuadClass", "i"),
    ("GoldsteinScale", "d"), ("NumMentions", "i"), ("NumSources", "i"), ("NumArticles", "i"), ("AvgTone", "d"),
    *((f"{who}_{part}", kind) for who in ("Actor1Geo", "Actor2Geo", "ActionGeo") for part, kind in _GEO),
    ("DATEADDED", "n"), ("SOURCEURL", "s"),
)

MENTION_FIELDS: tuple[tuple[str, str], ...] = (
    ("GLOBALEVENTID", "i"), ("EventTimeDate", "l"), ("MentionTimeDate", "l"), ("MentionType", "i"),
    ("MentionSourceName", "s"), ("MentionIdentifier", "s"), ("SentenceID", "i"),
    ("Actor1CharOffset", "i"), ("Actor2CharOffset", "i"), ("ActionCharOffset", "i"),
    ("InRawText", "i"), ("Confidence", "i"), ("MentionDocLen", "i"), ("MentionDocTone", "d"),
    ("MentionDocTranslationInfo", "s"),
)

GKG_FIELDS: tuple[tuple[str, str], ...] = (
    ("GKGRECORDID", "s"), ("DATE", "l"), ("SourceCollectionIdentifier", "i"), ("SourceCommonName", "s"),
    ("DocumentIdentifier", "s"), ("Counts", "s"), ("V2Counts", "s"), ("Themes", "s"), ("V2Themes", "s"),
    ("Locations", "s"), ("V2Locations", "s"), ("Persons", "s"), ("V2Persons", "s"), ("Organizations", "s"),
    ("V2Organizations", "s"), ("V2Tone", "s"), ("Dates", "s"), ("GCAM", "s"), ("SharingImage", "s"),
    ("RelatedImages", "s"), ("SocialImageEmbeds", "s"), ("SocialVideoEmbeds", "s"), ("Quotations", "s"),
    ("AllNames", "s"), ("Amounts", "s"),
)

# Fields a record must have, once trailing empty ones are gone: (fewest, most); None = no upper bound.
FIELD_COUNT: dict[str, tuple[int, int | None]] = {
    "export": (61, 61),
    "mentions": (14, None),
    "gkg": (25, None),
}

_TYPES = {
    "s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DoubleType(), "n": T.DecimalType(38, 0),
}


def _struct(fields, extra=()) -> T.StructType:
    out = T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])
    for name in extra:
        out = out.add(name, T.StringType())
    return out


EVENT_SCHEMA = _struct(EVENT_FIELDS)
MENTION_SCHEMA = _struct(MENTION_FIELDS, ("Extras", "SRCLC", "ENG"))
GKG_SCHEMA = _struct(GKG_FIELDS, ("TranslationInfo", "Extras"))
MANIFEST_SCHEMA = _struct((("size", "s"), ("md5", "s"), ("url", "s")))


@dataclass(frozen=True)
class MartSpec:
    """Columns of a mart, the key it is looked up by, and the order of the rows of one key."""

    schema: T.StructType
    key: tuple[str, ...]
    descending: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _mart(columns: str, key: tuple[str, ...], descending: tuple[str, ...]) -> MartSpec:
    types = {"int": T.IntegerType(), "string": T.StringType(), "float": T.FloatType(), "bigint": T.LongType()}
    fields = (column.split() for column in columns.split(", "))
    return MartSpec(T.StructType([T.StructField(name, types[kind]) for name, kind in fields]), key, descending)


_ITEM_MART = "date int, year string, month string, day string, source string, {} string, nbarticle int, tonemean float"

# Mart names, columns, types and keys.
MARTS: dict[str, MartSpec] = {
    "querya": _mart(
        "sqldate int, country string, language string, count int", ("sqldate", "country"), ("count",)),
    "queryb2": _mart(
        "country string, count int, sqldate string, year int, month int, day int, globaleventid int",
        ("globaleventid",), ("count",)),
    "queryctheme": _mart(_ITEM_MART.format("theme"), ("theme",), ("nbarticle",)),
    "querycperson": _mart(_ITEM_MART.format("person"), ("person",), ("nbarticle",)),
    "queryccountry": _mart(_ITEM_MART.format("country"), ("country",), ("nbarticle",)),
    "queryd2": _mart(
        "day int, month int, year int, n_articles int, mean_tone float, country1 string, country2 string",
        ("country1", "country2"), ("mean_tone", "n_articles")),
    # Roll-ups of the two marts above, stored so that they need not be rebuilt from records.
    "queryb2rollup": _mart(
        "country string, year int, month int, day int, level string, events int, mentions bigint",
        ("country",), ("mentions",)),
    "queryd2monthly": _mart(
        "country1 string, country2 string, month int, mean_tone float, n_articles int", ("country1", "country2"),
        ("n_articles",)),
}
