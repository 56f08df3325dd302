"""One write of valid and rejected rows, side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from cartwright import schemas
from cartwright.config import RuleBook
from cartwright.operators import quality, stage
from cartwright.sinks.hadoop import Files


def part(path: str, verdict: str) -> str:
    return f"{path}/{stage.VERDICT}={verdict}"


def land(raw: DataFrame, domain: str, rules: RuleBook, path: str) -> dict[str, int]:
    """Write the judged rows of a scan below ``path``, by verdict, and return its counters.

    The raw files are read once: the job that writes the rows observes the counters on its way. It
    has no shuffle, and Spark counts each of its tasks once even if one is repeated, so the observed
    numbers are exact. What ``path`` held before is replaced.
    """
    observation = Observation(f"{domain}_quality")
    stamped = stage.stamp(raw, domain, rules).observe(
        observation, *quality.counters(domain, rules)
    )
    judged = stage.judged_rows(stamped, domain, rules)
    judged.write.mode("overwrite").partitionBy(stage.VERDICT).parquet(path)
    files = Files(raw.sparkSession)
    for verdict in (stage.VALID, stage.REJECTED):
        files.make_dirs(part(path, verdict))
    return observation.get


def landed_schemas(
    spark: SparkSession, domain: str, rules: RuleBook
) -> tuple[T.StructType, T.StructType]:
    """Schemas of the valid rows and, without derived columns, of the rejected rows."""
    empty = spark.createDataFrame([], schemas.RAW[domain])
    stamped = stage.stamp(empty, domain, rules)
    return stage.derive(stamped, domain, rules).schema, stamped.schema
