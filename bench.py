"""Time the headline queries and the whole pipeline; print one JSON line.

BENCH_SF_DIR   directory of the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_COMPARE  1: also time the action-per-check way of running the same work
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwright import schemas  # noqa: E402
from cartwright.config import v2_rules  # noqa: E402
from cartwright.operators import enrich, quality, stage, validate  # noqa: E402
from cartwright.plans import catalog  # noqa: E402
from cartwright.plans.pipeline import Folders, Pipeline  # noqa: E402
from cartwright.sources.sample import raw_view, raw_views, sample_rules  # noqa: E402
from cartwright.sources.tables import TableStore  # noqa: E402

DIRECTORY = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RULES = sample_rules(v2_rules())

HEADLINE = (
    "orders_stage",
    "shipping_stage",
    "dq_orders",
    "dq_customers",
    "check_counts",
    "validation_results",
    "enriched_orders",
    "customer_analytics",
    "product_analytics",
    "analytics_summary",
    "seasonal_analysis",
    "segment_analysis",
    "category_analysis",
    "scd2_orders_second",
    "scd2_customers_second",
)


def session(home: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{home}/warehouse")
        .config("spark.checkpoint.dir", f"{home}/checkpoints")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def pipeline(spark: SparkSession, home: str, name: str) -> Pipeline:
    """A pipeline with freshly delivered CSV files."""
    folders = {}
    for domain in schemas.DOMAINS:
        folders[domain] = Folders(f"{home}/{name}/{domain}/in", f"{home}/{name}/{domain}/done")
        raw_view(spark, DIRECTORY, domain).write.options(
            header=True, timestampFormat="yyyy-MM-dd HH:mm:ss"
        ).csv(folders[domain].source)
    spark.sql(f"CREATE DATABASE {name}")
    return Pipeline(TableStore(spark, name), folders, f"{home}/{name}/store", RULES)


def pipeline_times(spark: SparkSession, home: str) -> tuple[dict[str, float], Pipeline]:
    # The bench files are small: cut them into as many splits as there are cores.
    spark.conf.set("spark.sql.files.openCostInBytes", "256k")
    made = pipeline(spark, home, "bench")
    steps = {
        "pipeline_load": made.load_all,
        "pipeline_validate": made.validate,
        "pipeline_enrich": made.enrich,
        "pipeline_merge_first": made.merge,
        "pipeline_merge_again": made.merge,
    }
    return {name: timed(step) for name, step in steps.items()}, made


def comparison(spark: SparkSession, made: Pipeline) -> dict[str, float]:
    """The same numbers from one plan, and from one action each."""
    stages, rules = made.stages(), made.rules
    raw = {d: stage.stamp(df, d, rules) for d, df in raw_views(spark, DIRECTORY).items()}

    def counters_one_by_one() -> None:
        for domain, df in raw.items():
            df = df.cache()
            df.count()
            for defect in quality.QUALITY[domain].defects(rules).values():
                df.filter(defect).count()
            quality.accept(df, domain, rules).count()
            quality.reject(df, domain, rules).count()
            df.unpersist()

    def checks_one_by_one() -> None:
        kept = [stages[d].cache() for d in ("orders", "customers", "products")]
        for df in stages.values():
            df.count()
        for name, rows in validate.OFFENDERS.items():
            if name != "stock_mismatch":
                rows(stages, rules).count()
        for df in kept:
            df.unpersist()

    def enrich_uncached() -> None:
        fact = enrich.enriched_orders(stages, rules)
        customers = enrich.customer_analytics(fact, stages["customers"], rules)
        products = enrich.product_analytics(fact, stages["products"], rules)
        for df in (fact, customers, products, fact, fact):
            df.count()
        for df, name in ((fact, "f"), (customers, "c"), (products, "p")):
            made.tables.overwrite(df, f"uncached_{name}")

    return {
        "counters_one_pass": timed(
            lambda: [run(quality.quality_report(df, d, rules)) for d, df in raw.items()]
        ),
        "counters_one_by_one": timed(counters_one_by_one),
        "checks_one_plan": timed(lambda: run(validate.check_counts(stages, rules))),
        "checks_one_by_one": timed(checks_one_by_one),
        "enrich_once": timed(made.enrich),
        "enrich_uncached": timed(enrich_uncached),
    }


def main() -> None:
    home = tempfile.mkdtemp(prefix="bench-")
    spark = session(home)
    queries = catalog.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        once = lambda: run(queries[name](spark, DIRECTORY))  # noqa: B023, E731
        once()
        times[name] = timed(once)
    steps, made = pipeline_times(spark, home)
    times.update(steps)
    result = {
        "metric": "total wall-clock of headline queries and pipeline steps",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(DIRECTORY.rstrip("/")).removeprefix("sf"),
    }
    if os.environ.get("BENCH_COMPARE") == "1":
        result["comparison"] = comparison(spark, made)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
