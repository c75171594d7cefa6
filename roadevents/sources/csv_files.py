"""CSV files, bound by position or by header name. All values are text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadevents.operators.normalize import CORRUPT
from roadevents.schema import FIELDS
from roadevents.sources.records import (
    VALUE_OPTIONS,
    bound_by_header,
    header_names,
    header_of,
    listing,
    text_schema,
)

READ_OPTIONS = {"header": True, **VALUE_OPTIONS}
ONLY_CSV = {"pathGlobFilter": "*.csv"}


def _reader(spark: SparkSession, multiline: bool):
    reader = spark.read.options(**READ_OPTIONS, multiLine=multiline, **ONLY_CSV)
    return reader.option("columnNameOfCorruptRecord", CORRUPT)


def csv_by_position(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str] = FIELDS,
    *,
    multiline: bool = True,
) -> DataFrame:
    """Columns take their names from ``fields`` in order; the header line is skipped.

    Short rows are filled with nulls and surplus values cut, and the text of such rows is
    in ``_corrupt_record``: ``normalize`` rejects them or aborts, and
    ``require_whole_records`` fails at the first. ``path`` is a folder, a file or a list of
    them. ``multiline=False`` lets Spark split large files, for data known to have no
    newline inside a field.
    """
    reader = _reader(spark, multiline).option("enforceSchema", True)
    return reader.schema(text_schema(fields)).csv(path if isinstance(path, str) else list(path))


def require_whole_records(raw: DataFrame) -> DataFrame:
    """The rows, failing at the first with a wrong number of values."""
    failed = F.raise_error(F.concat(F.lit("wrong number of values: "), F.col(CORRUPT)))
    whole = F.when(F.col(CORRUPT).isNull(), True).otherwise(failed.cast("boolean"))
    return raw.where(whole).drop(CORRUPT)


def select_by_name(df: DataFrame, fields: Sequence[str], *extra: str | Column) -> DataFrame:
    """``fields`` found without regard to case; missing ones null, others dropped."""
    found = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            F.col(f"`{found[f.lower()]}`").alias(f)
            if f.lower() in found
            else F.lit(None).cast("string").alias(f)
            for f in fields
        ],
        *[c for c in extra if not isinstance(c, str) or c in df.columns],
    )


def csv_by_name(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[str] = FIELDS,
    *,
    headers: str = "uniform",
    multiline: bool = True,
    partition_columns: Sequence[str] = (),
    encoding: str = "utf-8",
) -> DataFrame:
    """Columns bound by the header's names, without regard to case.

    ``path`` is a folder, a file or a list of them.
    ``headers="uniform"`` expects one header for all files and fails if a file's
    header differs, rather than shifting its columns. ``headers="per_file"`` reads every
    file by its own. Rows with a wrong number of values are filled or cut to fit and have
    their text in ``_corrupt_record``. ``encoding`` is one that writes ASCII as it is, line
    ends above all.
    """
    path = path if isinstance(path, str) else list(path)
    reader = _reader(spark, multiline).option("encoding", encoding)
    if headers == "uniform":
        header = [c for c in reader.csv(path).columns if c not in partition_columns]
        whole = reader.option("enforceSchema", False).schema(text_schema(header)).csv(path)
        return select_by_name(whole, fields, CORRUPT, *partition_columns)
    if headers != "per_file":
        raise ValueError(f"headers must be 'uniform' or 'per_file', not {headers!r}")
    # Tasks read the first block of every file; the driver learns the distinct headers.
    first = listing(spark, path, "*.csv").select(header_of(F.col("path"), encoding).alias("header"))
    layouts = [r["header"] for r in first.distinct().collect()]
    found = _whole_records(reader, path, max([1, *[len(header_names(h)) for h in layouts]]))
    return bound_by_header(
        found.withColumn("header", header_of(F.col("_file"), encoding, escaped=True)),
        layouts,
        fields,
        *partition_columns,
    )


def _whole_records(reader, path: str | list[str], widest: int) -> DataFrame:
    """Every record's own text as ``record``, its file, and the partition columns.

    The reader gives the text of records that do not fit its columns, so it is asked for
    one column more than any header has. A record of just that size is put together again
    from its values; it has one too many for every header.
    """
    places = [f"_place_{i}" for i in range(widest + 1)]
    read = reader.option("enforceSchema", True).schema(text_schema(places)).csv(path)
    values = [F.concat(F.lit('"'), F.replace(F.col(p), F.lit('"'), F.lit('""')), F.lit('"')) for p in places]
    rebuilt = F.concat_ws(",", *[F.coalesce(v, F.lit("")) for v in values])
    record = F.coalesce(F.col(CORRUPT), rebuilt).alias("record")
    others = [c for c in read.columns if c not in (*places, CORRUPT)]
    return read.select(record, F.col("_metadata.file_path").alias("_file"), *others)
