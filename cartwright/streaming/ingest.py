"""Exactly-once stage loads from a file stream.

Each micro-batch writes into directories named after its epoch and overwrites them, so a batch that
is replayed after a failure leaves one copy. Which files were ingested is recorded in the stream's
checkpoint; archiving is housekeeping and may lag one run behind.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwright.config import RuleBook
from cartwright.operators import quality, stage
from cartwright.sinks.hadoop import Files
from cartwright.sinks.landing import land, landed_schemas
from cartwright.sinks.process_log import log_row
from cartwright.sources.files import stream_csv


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names for checkpoints."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint directory")
    return root.rstrip("/")


@dataclass(frozen=True)
class EpochStore:
    """Stage, error and log rows of one domain, one directory per epoch below ``root``."""

    spark: SparkSession
    root: str
    domain: str

    def path(self, kind: str, epoch: int | None = None) -> str:
        path = f"{self.root.rstrip('/')}/{self.domain}_{kind}"
        return path if epoch is None else f"{path}/epoch={epoch}"

    def _landed(self, verdict: str, columns: T.StructType) -> DataFrame:
        places = T.StructType().add("epoch", T.LongType()).add(stage.VERDICT, T.StringType())
        schema = T.StructType([*columns.fields, *places.fields])
        rows = self.spark.read.schema(schema).parquet(self.path("landed"))
        return rows.filter(F.col(stage.VERDICT) == verdict).drop(stage.VERDICT)

    def stage(self, rules: RuleBook) -> DataFrame:
        """Valid rows of all epochs, with the epoch as a column."""
        return self._landed(stage.VALID, landed_schemas(self.spark, self.domain, rules)[0])

    def errors(self, rules: RuleBook) -> DataFrame:
        """Rejected rows of all epochs, stamped with the time their epoch was processed."""
        rows = self._landed(stage.REJECTED, landed_schemas(self.spark, self.domain, rules)[1])
        return quality.annotate_rejects(rows, rules).withColumn(
            "error_timestamp", F.col("processed_timestamp")
        )

    def log(self) -> DataFrame:
        return self.spark.read.parquet(self.path("log"))

    def latest(self, rules: RuleBook) -> DataFrame:
        """Valid rows of the newest epoch: what a batch run would have left in the stage table."""
        names = Files(self.spark).names(self.path("landed"))
        newest = max(int(name.removeprefix("epoch=")) for name in names if "=" in name)
        return self.stage(rules).filter(F.col("epoch") == newest).drop("epoch")


def ingest_available(
    store: EpochStore,
    source: str,
    rules: RuleBook,
    checkpoint: str | None = None,
    archive_dir: str | None = None,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load every file not seen before and stop; without new files nothing is written."""
    spark, domain = store.spark, store.domain
    stream = stream_csv(
        spark, domain, source, files_per_trigger=files_per_trigger, archive_dir=archive_dir
    )

    def load(batch: DataFrame, epoch: int) -> None:
        pinned = rules.pinned(spark)
        counts = land(batch, domain, pinned, store.path("landed", epoch))
        row = log_row(
            spark,
            f"{domain}_stage_load",
            counts["total_records"],
            counts["valid_records"],
            counts["invalid_records"],
            0,
            pinned,
        )
        row.write.mode("overwrite").parquet(store.path("log", epoch))

    location = checkpoint or f"{checkpoint_root(spark)}/cartwright/{domain}_ingest"
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
