"""Type 2 histories as partitioned catalog tables.

A history lies in buckets by a hash of its key. A merge reads and overwrites the buckets that its batch
hits, and no others. Where closed rows are final they lie, within their bucket, in a partition of the
day they were closed, so that earlier closed rows aren't read or written again; rows that are current have no
such day and share one partition per bucket. Where closed rows may change, a bucket is one partition.

Rows without a key never expire. Those of a load lie in a bucket of the load's day, which a batch of another
day doesn't touch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.config import RuleBook
from cartwright.operators.joins import DEFAULT_SKEW, SkewPolicy
from cartwright.operators.scd2 import History, scd2_apply, stamp_current
from cartwright.sources.tables import TableStore

BUCKET = "history_bucket"
CLOSED_ON = "expiry_date"


@dataclass(frozen=True)
class HistoryTable:
    """The history ``table`` of a store, with its files in ``location``.

    The number of buckets must stay what it was for the first batch. It bounds what a merge lists on the
    driver; a large history wants so many that a bucket's current rows are a few gigabytes.
    """

    tables: TableStore
    table: str
    location: str
    buckets: int = 16

    def exists(self) -> bool:
        return self.tables.exists(self.table)

    def _stored(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no history {self.tables.name(self.table)}")
        return self.tables.read(self.table)

    def read(self) -> DataFrame:
        rows = self._stored()
        # Partition columns come last in a table; here the flag does.
        names = [name for name in rows.columns if name not in (BUCKET, CLOSED_ON, "is_current")]
        return rows.select(*names, CLOSED_ON, "is_current")

    def current(self) -> DataFrame:
        return self.read().filter("is_current")

    def _bucket(self, key: str, effective: Column) -> Column:
        """0 to ``buckets`` - 1 for a key; below zero, by day, without one."""
        day = F.datediff(effective, F.lit("1970-01-01").cast("date"))
        return F.when(F.col(key).isNull(), -1 - day).otherwise(
            F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")
        )

    def merge(
        self,
        batch: DataFrame,
        history: History,
        rules: RuleBook,
        policy: SkewPolicy = DEFAULT_SKEW,
    ) -> list[int]:
        """Apply a batch; the first one creates the table. Returns the buckets that were written."""
        guard = history.guarded(rules)
        layout = [BUCKET, CLOSED_ON] if guard else [BUCKET]
        in_bucket = self._bucket(history.key, F.col("effective_date"))
        added = stamp_current(batch, rules)
        hit = sorted(row[0] for row in added.select(in_bucket).distinct().collect())
        if not self.exists():
            schema = T.StructType([*added.schema, T.StructField(BUCKET, T.IntegerType())])
            self.tables.create_partitioned(self.table, schema, layout, self.location)
            after = added
        else:
            if self.tables.partitioned_by(self.table) != layout:
                raise ValueError(f"{self.table} was laid out for other rules")
            slice_ = self._stored().filter(F.col(BUCKET).isin(hit))
            if guard:
                # Rows closed on this day by an earlier run share the partition this run writes.
                slice_ = slice_.filter(F.col(CLOSED_ON).isNull() | (F.col(CLOSED_ON) == rules.today()))
            target = slice_.select(*added.columns)
            after = scd2_apply(target, batch, history.key, rules, guard, policy)
        if hit:
            self.tables.replace_partitions(after.withColumn(BUCKET, in_bucket), self.table, layout, self.location)
        return hit
