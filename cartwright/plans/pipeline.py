"""The whole run in order: stage loads, validation, enrichment, history and summaries."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cartwright import schemas
from cartwright.config import RuleBook
from cartwright.operators import enrich, quality, stage, summary, validate
from cartwright.operators.joins import DEFAULT_SKEW, SkewPolicy
from cartwright.operators.scd2 import HISTORIES, History
from cartwright.sinks.archive import archive_csv, check_archive, file_set
from cartwright.sinks.hadoop import Files
from cartwright.sinks.history import HistoryTable
from cartwright.sinks.landing import land, landed_schemas, part
from cartwright.sinks.process_log import FROM_COUNTS, log_row
from cartwright.sources.files import scan_csv
from cartwright.sources.tables import TableStore, rows_of

T = TypeVar("T")

#: What tells the loads in a table of rejects apart.
LOAD = "load_id"


@dataclass(frozen=True)
class Folders:
    """Where the raw files of one domain arrive and where they go once ingested."""

    source: str
    archive: str


@dataclass(frozen=True)
class LoadCounts:
    domain: str
    counts: dict[str, int]
    archived: int


def concurrently(spark: SparkSession, work: list[Callable[[], T]]) -> list[T]:
    """Run independent Spark actions side by side, so that one fills the idle tail of another."""

    def call(item: Callable[[], T]) -> T:
        return item()

    with ThreadPoolExecutor(max_workers=len(work)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(call), work))


class Pipeline:
    """A run over ``tables``.

    Stage rows and histories are kept below ``root``, a directory that all executors can reach.
    """

    def __init__(
        self,
        tables: TableStore,
        folders: dict[str, Folders],
        root: str,
        rules: RuleBook,
        policy: SkewPolicy = DEFAULT_SKEW,
        history_buckets: int = 16,
    ) -> None:
        self.history_buckets = history_buckets
        self.spark: SparkSession = tables.spark
        self.tables = tables
        self.folders = folders
        self.root = root.rstrip("/")
        self.rules = rules.pinned(self.spark)
        self.policy = policy

    def history(self, table: str) -> HistoryTable:
        return HistoryTable(self.tables, table, f"{self.root}/history/{table}", self.history_buckets)

    def log(
        self,
        task: str,
        total: int | None = None,
        valid: int | None = None,
        invalid: int | None = None,
        archived: int | None = None,
        status: str | None = FROM_COUNTS,
    ) -> None:
        row = log_row(self.spark, task, total, valid, invalid, archived, self.rules, status)
        self.tables.append(row, "process_log")

    def load(self, domain: str) -> LoadCounts:
        """Ingest one domain: replace its stage table, append its rejects, archive its files."""
        rules, spark = self.rules, self.spark
        raw = scan_csv(spark, domain, self.folders[domain].source)
        check_archive(raw, self.folders[domain].archive)
        home = f"{self.root}/landing/{domain}"
        run = f"{rules.batch()}-{uuid.uuid4().hex[:8]}"
        counts = land(raw, domain, rules, f"{home}/{run}")
        valid, rejected = landed_schemas(spark, domain, rules)
        self.tables.point(f"{domain}_stage", part(f"{home}/{run}", stage.VALID), valid)
        if counts["invalid_records"] > 0:
            rows = spark.read.schema(rejected).parquet(part(f"{home}/{run}", stage.REJECTED))
            self._add_errors(domain, quality.annotate_rejects(rows, rules), file_set(raw))
        archived = archive_csv(raw, self.folders[domain].archive)
        # The stage table shows this run alone, so the files of earlier runs have no reader left.
        files = Files(spark)
        for earlier in files.names(home):
            if earlier != run:
                files.remove(f"{home}/{earlier}")
        return LoadCounts(domain, counts, archived)

    def _add_errors(self, domain: str, rejects: DataFrame, files: str) -> None:
        """Add rejects to the domain's errors, in place of those an earlier attempt on the same files left."""
        loads, location = f"{domain}_error_loads", f"{self.root}/errors/{domain}"
        load = F.lit(f"{self.rules.batch()}-{files}")
        rows = rejects.withColumn(LOAD, load)
        self.tables.create_partitioned(loads, rows.schema, [LOAD], location)
        self.tables.replace_partitions(rows, loads, [LOAD], location)
        self.tables.show(f"{domain}_errors", loads, rejects.columns)

    def load_all(self) -> list[LoadCounts]:
        """All domains at once; the log is written afterwards, by one writer.

        If some fail, the others are logged all the same before the first failure is raised.
        """

        def attempt(domain: str) -> LoadCounts | Exception:
            try:
                return self.load(domain)
            except Exception as failure:  # raised below
                return failure

        outcomes = concurrently(self.spark, [partial(attempt, d) for d in schemas.DOMAINS])
        loads = [done for done in outcomes if isinstance(done, LoadCounts)]
        for done in loads:
            self.log(
                f"{done.domain}_stage_load",
                done.counts["total_records"],
                done.counts["valid_records"],
                done.counts["invalid_records"],
                done.archived,
            )
        for failure in outcomes:
            if isinstance(failure, Exception):
                raise failure
        return loads

    def stages(self) -> dict[str, DataFrame]:
        return {domain: self.tables.read(f"{domain}_stage") for domain in schemas.DOMAINS}

    def validate(self) -> Row:
        """Run all checks as one query, store the results and return the gate row.

        A failed gate does not stop the run; that is the caller's decision.
        """
        rules, stages = self.rules, self.stages()
        results = validate.validation_results(stages, rules, self.policy, rows=rows_of(stages))
        if rules.is_v1:
            self.tables.append(results, "validation_results")
        else:
            self.tables.overwrite(results, "validation_results")
        stored = self.tables.read("validation_results")
        if rules.is_v1:
            stored = stored.filter(stored.batch_id == rules.batch())
        gate = validate.validation_gate(stored, rules).first()
        if rules.is_v1:
            self.log("data_validation", status=None)
        else:
            self.log(
                "data_validation", gate["total_findings"], 0, gate["high_severity_issues"], 0
            )
        return gate

    def enrich(self) -> int:
        """Build the order fact once, and both analytics tables from the stored fact."""
        rules, stages = self.rules, self.stages()
        self.tables.overwrite(
            enrich.enriched_orders(stages, rules, self.policy), "enriched_orders"
        )
        fact = self.tables.read("enriched_orders")
        customers = enrich.customer_analytics(fact, stages["customers"], rules, self.policy)
        products = enrich.product_analytics(fact, stages["products"], rules, self.policy)
        *_, rows = concurrently(
            self.spark,
            [
                partial(self.tables.overwrite, customers, "customer_analytics"),
                partial(self.tables.overwrite, products, "product_analytics"),
                fact.count,
            ],
        )
        if rules.is_v1:
            self.log("data_enrichment", status="SUCCESS")
        else:
            self.log("data_enrichment", rows, rows, 0, 0)
        return rows

    def merge(self) -> Row:
        """Extend the three histories, write the four reports and return the global summary."""
        rules, tables = self.rules, self.tables

        def extend(table: str, history: History) -> None:
            batch = history.batch(tables.read(history.source))
            self.history(table).merge(batch, history, rules, self.policy)

        fact = tables.read("enriched_orders")
        reports = {
            "analytics_summary": summary.analytics_summary(fact, rules),
            "seasonal_analysis": summary.seasonal_analysis(fact),
            "segment_analysis": summary.segment_analysis(tables.read("customer_analytics")),
            "category_analysis": summary.category_analysis(tables.read("product_analytics")),
        }
        concurrently(
            self.spark,
            [
                *(partial(extend, table, history) for table, history in HISTORIES.items()),
                *(partial(tables.overwrite, report, table) for table, report in reports.items()),
            ],
        )
        totals = tables.read("analytics_summary").first()
        orders = totals["total_orders"]
        if rules.is_v1:
            self.log("final_merge_operation", orders, orders, status="SUCCESS")
        else:
            self.log("final_merge_operation", orders, orders, 0, 0)
        return totals

    def run(self) -> Row:
        self.load_all()
        self.validate()
        self.enrich()
        return self.merge()
