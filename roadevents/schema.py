"""Declared schemas of the incident tables.

Every reader and table uses one of these; nothing is inferred from the data.
"""

from pyspark.sql import types as T

# The field names of a road-incident record, in file order.
FIELDS = (
    "type",
    "eventType",
    "eventDetailType",
    "startDate",
    "coordX",
    "coordY",
    "linkId",
    "roadName",
    "roadNo",
    "roadDrcType",
    "lanesBlockType",
    "lanesBlocked",
    "message",
    "endDate",
)

# Text that stands for a missing value.
NULL_MARKERS = ("-", "NULL")
NUMBER_BLANKS = ("", "-", "nan", "None")
END_DATE_BLANKS = ("",)
MISSING_TEXT = ("nan", "None")

# The keys of the two write policies.
MERGE_KEYS = ("startDate", "linkId")
LATEST_KEYS = ("startDate", "coordX", "coordY")

DOUBLE_FIELDS = ("coordX", "coordY")
LONG_FIELDS = ("linkId", "roadNo")
DATE_FIELDS = ("startDate", "endDate")


def _typed(date_type: T.DataType) -> T.StructType:
    special = {
        **dict.fromkeys(DOUBLE_FIELDS, T.DoubleType()),
        **dict.fromkeys(LONG_FIELDS, T.LongType()),
        **dict.fromkeys(DATE_FIELDS, date_type),
    }
    return T.StructType(
        [T.StructField(f, special.get(f, T.StringType())) for f in FIELDS]
    )


#: 14 text columns, as landed.
RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])

#: Numbers and timestamps typed.
EVENT_SCHEMA = _typed(T.TimestampNTZType())

#: Numbers typed, dates kept as the source text.
TEXT_DATE_SCHEMA = _typed(T.StringType())

#: The central table kept by the latest-per-key policy.
CENTRAL_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields + [T.StructField("createdAt", T.TimestampType())]
)

#: The table kept by the merge policy.
MERGE_SCHEMA = T.StructType(
    TEXT_DATE_SCHEMA.fields
    + [T.StructField("ingestion_timestamp", T.TimestampNTZType())]
)

#: One poll response: ``{"body": {"items": [record, ...]}}``.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField(
            "body",
            T.StructType([T.StructField("items", T.ArrayType(RAW_SCHEMA))]),
        )
    ]
)
