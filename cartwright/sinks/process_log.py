"""The run log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.config import RUN_STATUS, RuleBook

# Column order of the log table.
LOG_COLUMNS = (
    "archived_files",
    "invalid_records",
    "status",
    "task",
    "timestamp",
    "total_records",
    "valid_records",
)
_COUNTS = "task STRING, total_records BIGINT, valid_records BIGINT, invalid_records BIGINT, archived_files BIGINT"

FROM_COUNTS = "from counts"


def log_rows(counts: DataFrame, rules: RuleBook, status: str | None = FROM_COUNTS) -> DataFrame:
    """Log rows from rows of (task, total, valid and invalid records, archived files).

    The status follows from the rejected count unless one is given; it may also be given as None.
    """
    given = RUN_STATUS.column() if status == FROM_COUNTS else F.lit(status).cast("string")
    moment = F.date_format(rules.clock(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return counts.withColumns({"status": given, "timestamp": moment}).select(*LOG_COLUMNS)


def log_row(
    spark: SparkSession,
    task: str,
    total: int | None,
    valid: int | None,
    invalid: int | None,
    archived: int | None,
    rules: RuleBook,
    status: str | None = FROM_COUNTS,
) -> DataFrame:
    counts = spark.createDataFrame([(task, total, valid, invalid, archived)], _COUNTS)
    return log_rows(counts, rules, status)
