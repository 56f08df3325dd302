"""Named tables: scans, overwrites and appends in one namespace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rows_of(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    """The rows of every named frame, by one job; of files that are read whole it takes the footers alone."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in frames.items()
    ]
    return {row.name: row.rows for row in reduce(DataFrame.unionAll, counts).collect()}


@dataclass(frozen=True)
class TableStore:
    """Tables of a pipeline in ``namespace`` (``database`` or ``catalog.database``)."""

    spark: SparkSession
    namespace: str = "default"
    format: str | None = None

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.table(self.name(table))

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        writer = df.write.mode(mode)
        if self.format is not None:
            writer = writer.format(self.format)
        writer.saveAsTable(self.name(table))

    def overwrite(self, df: DataFrame, table: str) -> None:
        self._write(df, table, "overwrite")

    def append(self, df: DataFrame, table: str) -> None:
        self._write(df, table, "append")

    def point(self, table: str, path: str, schema: T.StructType) -> None:
        """Make the table show the parquet files of ``path``, whatever it showed before."""
        name = self.name(table)
        if self.spark.catalog.tableExists(name):
            if self.spark.table(name).schema.simpleString() == schema.simpleString():
                # Readers see the one location or the other, never no table.
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(path)}")
                self.spark.catalog.refreshTable(name)
                return
            self.spark.sql(f"DROP TABLE {name}")
        self.spark.catalog.createTable(name, path, "parquet", schema)

    def create(self, df: DataFrame, table: str) -> None:
        """Write a new table; an existing one is an error."""
        self._write(df, table, "errorifexists")

    def create_partitioned(
        self, table: str, schema: T.StructType, by: Sequence[str], location: str
    ) -> None:
        """Make a table of parquet files in ``location``, without rows, unless there is one."""
        # Partition columns last, as the table will show them.
        fields = sorted(schema.fields, key=lambda f: by.index(f.name) if f.name in by else -1)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) USING parquet"
            f" PARTITIONED BY ({', '.join(by)}) LOCATION {quoted(location)}"
        )

    def partitioned_by(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def replace_partitions(
        self, df: DataFrame, table: str, by: Sequence[str], location: str
    ) -> None:
        """Overwrite the partitions that ``df`` has rows for; all others stay as they are.

        ``df`` may read the table: the new files are staged and take the place of the old ones when all
        are written, so a run that dies before leaves the table as it was.
        """
        # By partition, so that few files are written; a partition with very many rows is split.
        dealt = df.select(*self.read(table).columns).hint("rebalance", *map(F.col, by))
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*by).parquet(location)
        self.spark.catalog.recoverPartitions(self.name(table))
        self.spark.catalog.refreshTable(self.name(table))

    def show(self, view: str, table: str, columns: Sequence[str]) -> None:
        """Make ``view`` show some columns of a table."""
        names = ", ".join(f"`{name}`" for name in columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(view)} AS SELECT {names} FROM {self.name(table)}"
        )
