"""Typed scans of the raw CSV directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwright import schemas
from cartwright.config import CSV_OPTIONS


def scan_csv(
    spark: SparkSession,
    domain: str,
    path: str,
    strict_header: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """All files of a directory under the domain's fixed schema.

    Columns bind by position and a value that does not parse becomes NULL. ``strict_header`` makes
    a header that differs from the schema an error. ``corrupt_column`` names a further column with the
    whole line of every row that lost something: a value that did not parse, a missing or a surplus
    field. The file list is taken now: files that arrive later belong to the next run.
    """
    schema = schemas.RAW[domain]
    reader = spark.read.options(**CSV_OPTIONS, mode="PERMISSIVE")
    if corrupt_column is not None:
        schema = f"{schema}, `{corrupt_column}` STRING"
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    reader = reader.schema(schema)
    if strict_header:
        reader = reader.option("enforceSchema", "false")
    return reader.csv(path)


def stream_csv(
    spark: SparkSession,
    domain: str,
    path: str,
    files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """The same directory as an unbounded source that yields every file once.

    With ``archive_dir`` Spark moves files there after the batch that follows theirs, keeping their
    path below it.
    """
    reader = spark.readStream.schema(schemas.RAW[domain]).options(**CSV_OPTIONS)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.csv(path)
