"""Raw landing-zone scans (CSV with header, JSON) and Parquet table reads.

Raw files are read with a declared all-string schema: no inference pass over
the data, no surprise types, and malformed cells survive to ``try_cast``.
JSON should land as JSON lines so files split across tasks; a JSON array
(``multiline=True``) cannot be split and is read by one task per file.  It is read as
one line up to a separator no file has: the scan then parses it from memory, where
``multiLine`` goes back to the file for the text of every number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Text form used for timestamps in landed files (microseconds kept).
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
FILE_FORMAT = {
    "users": "csv",
    "subscriptions": "csv",
    "content_catalog": "csv",
    "watch_events": "json",
}


REJECTED = "_corrupt_record"
NEVER = "\u001e\n\u001e\n"    # control characters JSON texts do not hold


def read_raw(spark: SparkSession, path: str, table: str, fmt: str | None = None,
             multiline: bool = False, keep_rejected: bool = False) -> DataFrame:
    """Raw rows, all text.  With ``keep_rejected`` a row that does not parse keeps its
    text in the column REJECTED (``split_rejected``) instead of turning into NULLs."""
    typed, _ = schemas.RAW[table]
    fmt = fmt or FILE_FORMAT[table]
    fields = schemas.as_strings(typed)
    if keep_rejected:
        fields = fields.add(REJECTED, "string")
    reader = spark.read.schema(fields).option("columnNameOfCorruptRecord", REJECTED).option("mode", "PERMISSIVE")
    if fmt == "csv":
        # enforceSchema=false: the header is checked against the declared
        # names, so a file with reordered columns fails instead of loading
        # values into the wrong columns by position.
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    if fmt == "json":
        return (reader.option("lineSep", NEVER) if multiline else reader).json(path)
    raise ValueError(f"unsupported raw format {fmt!r}")


def split_rejected(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, (record, source_path) of the others)."""
    bad = F.col(REJECTED).isNotNull()
    # ``key`` keeps a parsed column in the scan: it cannot read the rejected text alone
    rejected = df.where(bad).select(F.when(F.col(key).isNotNull() | bad, F.col(REJECTED)).alias("record"), "source_path")
    return df.where(~bad).drop(REJECTED), rejected


def write_raw(df: DataFrame, path: str, table: str, fmt: str | None = None) -> None:
    """Land a raw table as files (used by tests, the bench and fixtures)."""
    fmt = fmt or FILE_FORMAT[table]
    w = (df.write.mode("overwrite")
         .option("timestampNTZFormat", TS_TEXT)
         .option("timestampFormat", TS_TEXT))
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unsupported raw format {fmt!r}")


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 2000) -> None:
    """Land a table as files that each hold one JSON array."""
    files = 1 + df.count() // rows_per_file
    line = F.to_json(F.struct(*df.columns), {"timestampNTZFormat": TS_TEXT, "timestampFormat": TS_TEXT})
    arrays = df.select(line.alias("j")).groupBy(F.pmod(F.xxhash64("j"), F.lit(files)).alias("part")).agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list("j"), ",\n"), F.lit("\n]")).alias("value"))
    arrays.write.mode("overwrite").partitionBy("part").text(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def source_file_column() -> F.Column:
    """The physical file a row came from (file scans only)."""
    return F.col("_metadata.file_path")
