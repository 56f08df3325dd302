"""Named queries over the sample views: one per operator of the library.

Every query returns plain types (bigint, double, string, date, boolean) so that its rows can be
compared with those of another engine: timestamps become text, arrays joined text, and decimals
doubles, rounded to six places where they carry more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright import schemas
from cartwright.config import CSV_OPTIONS, RuleBook, v1_rules, v2_rules
from cartwright.operators import enrich, quality, scd2, stage, summary, validate
from cartwright.operators.joins import DEFAULT_SKEW, SkewPolicy
from cartwright.sinks.hadoop import Files
from cartwright.sinks.process_log import log_row, log_rows
from cartwright.sinks.shared import shared_folder, stored, stored_and_counted
from cartwright.sources.files import scan_csv
from cartwright.sources.sample import AS_OF, deliver_csv, most_rows, raw_view, raw_views, sample_rules
from cartwright.streaming.ingest import EpochStore, ingest_available

Query = Callable[[SparkSession, str], DataFrame]

V2 = sample_rules(v2_rules())
V2_STRICT = sample_rules(v2_rules(null_policy="reject"))
V1 = sample_rules(v1_rules())

# Spreads every key with more than 50 rows, whatever the size of the sides.
FINE_SPREAD = SkewPolicy(rows_per_cell=50, always_spread=True)

# The two loads of the history queries cover overlapping periods, together all orders; a single
# first load takes all of them.
FIRST_LOAD = "order_date < DATE'2001-01-01'"
SECOND_LOAD = "order_date >= DATE'2000-07-01' OR order_date IS NULL"


def plain(df: DataFrame) -> DataFrame:
    def plain_column(field: T.StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, T.DecimalType):
            value = f"cast({f'round({name}, 6)' if kind.scale > 6 else name} AS double)"
        elif isinstance(kind, T.IntegerType):
            value = f"cast({name} AS bigint)"
        elif isinstance(kind, T.TimestampType):
            value = f"cast({name} AS string)"
        elif isinstance(kind, T.ArrayType):
            value = f"array_join({name}, '|')"
        else:
            value = name
        return f"{value} AS {name}"

    return df.selectExpr(*map(plain_column, df.schema))


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round sums of doubles, which depend on the order of addition."""
    return df.withColumns({name: F.round(name, digits) for name in names})


def sample_stages(
    spark: SparkSession,
    directory: str,
    rules: RuleBook,
    domains: tuple[str, ...] = schemas.DOMAINS,
    rows: Mapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    raw = raw_views(spark, directory, domains, rows)
    return {domain: stage.stage_rows(raw[domain], domain, rules) for domain in domains}


def sample_fact(
    spark: SparkSession, directory: str, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW
) -> tuple[DataFrame, dict[str, DataFrame]]:
    stages = sample_stages(spark, directory, rules)
    return enrich.enriched_orders(stages, rules, policy), stages


# --- builders -----------------------------------------------------------------------------------


def _stamped(spark: SparkSession, directory: str, domain: str, rules: RuleBook) -> DataFrame:
    return stage.stamp(raw_view(spark, directory, domain), domain, rules)


def _valid(domain: str) -> Query:
    return lambda spark, d: plain(quality.accept(_stamped(spark, d, domain, V2), domain, V2))


def _scanned(domain: str) -> Query:
    """The domain's raw rows, written as CSV files with defects and scanned under its schema."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        folder = shared_folder(spark, f"{domain}_csv")
        deliver_csv(spark, directory, domain, folder)
        rows = scan_csv(spark, domain, folder, corrupt_column="corrupt_line")
        return plain(rows.withColumn("is_corrupt", F.col("corrupt_line").isNotNull()).drop("corrupt_line"))

    return query


def _rejected(domain: str, rules: RuleBook) -> Query:
    return lambda spark, d: plain(stage.error_rows(raw_view(spark, d, domain), domain, rules))


def _report(domain: str, rules: RuleBook) -> Query:
    return lambda spark, d: plain(
        quality.quality_report(_stamped(spark, d, domain, rules), domain, rules)
    )


def _staged(domain: str, rules: RuleBook) -> Query:
    return lambda spark, d: plain(stage.stage_rows(raw_view(spark, d, domain), domain, rules))


def _streamed(spark: SparkSession, directory: str) -> DataFrame:
    """The order stage from a file stream: two drops of files, each run to its end, and a replay.

    The second epoch's commit is taken back, as if the run had died before it, so the stream loads
    that epoch again. A last run finds no new files.
    """
    drops, checkpoint = shared_folder(spark, "drops"), shared_folder(spark, "stream")
    store = EpochStore(spark, shared_folder(spark, "epochs"), "orders")
    rows = raw_view(spark, directory, "orders")
    early = F.coalesce(F.expr(FIRST_LOAD), F.lit(False))

    def run() -> None:
        ingest_available(store, drops, V2, checkpoint).awaitTermination()

    for when in (early, ~early):
        rows.filter(when).write.mode("append").options(**CSV_OPTIONS).csv(drops)
        run()
    Files(spark).remove(f"{checkpoint}/commits/1")
    run()
    run()
    return plain(store.stage(V2).drop("epoch"))


def _offenders(check: str, rules: RuleBook) -> Query:
    domains = validate.DOMAINS_OF[check]
    return lambda spark, d: plain(
        validate.OFFENDERS[check](sample_stages(spark, d, rules, domains), rules)
    )


def _counts(rules: RuleBook) -> Query:
    def query(spark: SparkSession, directory: str) -> DataFrame:
        rows = most_rows(spark, directory)
        return plain(validate.check_counts(sample_stages(spark, directory, rules, rows=rows), rules, rows=rows))

    return query


def _results(spark: SparkSession, directory: str, rules: RuleBook) -> DataFrame:
    rows = most_rows(spark, directory)
    return validate.validation_results(sample_stages(spark, directory, rules, rows=rows), rules, rows=rows)


def _gate(rules: RuleBook) -> Query:
    return lambda spark, d: plain(validate.validation_gate(_results(spark, d, rules), rules))


def _validation_log(spark: SparkSession, directory: str) -> DataFrame:
    gate = validate.validation_gate(_results(spark, directory, V2), V2)
    counts = gate.select(
        F.lit("data_validation").alias("task"),
        F.col("total_findings").alias("total_records"),
        F.lit(0).alias("valid_records"),
        F.col("high_severity_issues").alias("invalid_records"),
        F.lit(0).alias("archived_files"),
    )
    return plain(log_rows(counts, V2))


def _v1_log(spark: SparkSession, directory: str) -> DataFrame:
    """What the older steps log: no counts and no status of the validation, totals of the merge alone."""
    fact, _ = sample_fact(spark, directory, V1)
    orders = F.count("order_id")
    counts = fact.agg(orders.alias("total_records"), orders.alias("valid_records")).withColumns(
        {"task": F.lit("final_merge_operation"), "invalid_records": F.lit(None), "archived_files": F.lit(None)}
    )
    steps = [
        log_row(spark, "data_validation", None, None, None, None, V1, status=None),
        log_row(spark, "data_enrichment", None, None, None, None, V1, status="SUCCESS"),
        log_rows(counts, V1, status="SUCCESS"),
    ]
    return plain(reduce(DataFrame.unionByName, steps))


def _v1_appended_results(spark: SparkSession, directory: str) -> DataFrame:
    """The older results table after two runs: each adds its rows to those of the runs before."""
    folder = shared_folder(spark, "validation_results")
    results = _results(spark, directory, V1)
    for batch in (V1.batch(), "later"):
        results.withColumn("batch_id", F.lit(batch)).write.mode("append").parquet(folder)
    return plain(spark.read.schema(results.schema).parquet(folder))


def _process_log(spark: SparkSession, directory: str) -> DataFrame:
    raw = raw_views(spark, directory)
    counts = [
        quality.quality_report(stage.stamp(raw[domain], domain, V2), domain, V2).select(
            F.lit(f"{domain}_stage_load").alias("task"),
            "total_records",
            "valid_records",
            "invalid_records",
            F.lit(0).alias("archived_files"),
        )
        for domain in schemas.DOMAINS
    ]
    return plain(log_rows(reduce(DataFrame.unionByName, counts), V2))


#: What the analytics and their history read of the order fact.
SALES = (
    "order_id", "customer_id", "product_id", "order_date", "order_amount", "category",
    "order_profit_margin", "estimated_clv",
)


def _row_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of the eight tables: those that are written are counted by their writes."""
    stages, counts = {}, {}
    for domain, df in sample_stages(spark, directory, V2).items():
        stages[domain], counts[f"{domain}_stage"] = stored_and_counted(df, f"{domain}_stage")
    fact = enrich.enriched_orders(stages, V2).select(*SALES)
    fact, counts["enriched_orders"] = stored_and_counted(fact, "enriched_orders")
    written = spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")
    analytics = {
        "customer_analytics": enrich.customer_analytics(fact, stages["customers"], V2),
        "product_analytics": enrich.product_analytics(fact, stages["products"], V2),
    }
    others = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in analytics.items()
    ]
    return plain(reduce(DataFrame.unionByName, others, written))


def _fact(rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW) -> Query:
    return lambda spark, d: plain(sample_fact(spark, d, rules, policy)[0])


def _customers(
    spark: SparkSession, directory: str, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    fact, stages = sample_fact(spark, directory, rules)
    return enrich.customer_analytics(fact, stages["customers"], rules, policy)


def _products(
    spark: SparkSession, directory: str, rules: RuleBook, policy: SkewPolicy = DEFAULT_SKEW
) -> DataFrame:
    fact, stages = sample_fact(spark, directory, rules)
    return enrich.product_analytics(fact, stages["products"], rules, policy)


# What each history takes from the order fact, and how its rows come from the part of one load.
_SOURCES: dict[str, tuple[tuple[str, ...], Callable[[DataFrame, dict, RuleBook], DataFrame]]] = {
    "orders_target": (scd2.ORDER_HISTORY, lambda fact, stages, rules: fact),
    "customers_target": (
        SALES,
        lambda fact, stages, rules: enrich.customer_analytics(fact, stages["customers"], rules),
    ),
    "products_target": (
        SALES,
        lambda fact, stages, rules: enrich.product_analytics(fact, stages["products"], rules),
    ),
}


def _history(table: str, rules: RuleBook, load_twice: bool, closed: bool = False) -> Query:
    """History after one or two loads, the second on the day after the first.

    With ``closed`` the history already holds versions that were closed a month earlier.
    """
    history = scd2.HISTORIES[table]
    second_day = replace(rules, as_of=AS_OF + dt.timedelta(days=1))
    columns, rows_of = _SOURCES[table]

    def query(spark: SparkSession, directory: str) -> DataFrame:
        fact, stages = sample_fact(spark, directory, rules)
        fact = fact.select(*columns)
        # Both loads read the one fact.
        fact = stored(fact, "fact") if load_twice else fact

        # Order rows are the stored fact's own; only what was computed from it is stored again.
        kept = stored if load_twice and table != "orders_target" else lambda df, label: df

        def load(when: str) -> DataFrame:
            return history.batch(rows_of(fact.filter(when), stages, rules))

        # The rows themselves are computed as of the sample's day; only the history moves on.
        state = scd2.stamp_current(kept(load(FIRST_LOAD if load_twice else "true"), "first"), rules)
        older = None
        if closed:
            month_ago = F.lit(AS_OF - dt.timedelta(days=30))
            dates = {"effective_date": month_ago, "expiry_date": F.lit(AS_OF)}
            older = state.withColumns({**dates, "is_current": F.lit(False)})
        guard = history.guarded(rules)
        if older is not None and not guard:
            state, older = state.unionByName(older), None
        if load_twice:
            state = scd2.scd2_apply(state, kept(load(SECOND_LOAD), "batch"), history.key, second_day, guard)
        # Under the guard closed rows stay as they are, so they need not pass the update.
        return plain(state if older is None else state.unionByName(older))

    return query


def _summary(rules: RuleBook) -> Query:
    def query(spark: SparkSession, directory: str) -> DataFrame:
        fact, _ = sample_fact(spark, directory, rules)
        report = summary.analytics_summary(fact, rules)
        if rules.is_v1:
            report = rounded(report, 3, "total_profit")
            report = rounded(report, 6, rules.profit_ratio_name)
        return plain(report)

    return query


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {}
    for domain in schemas.DOMAINS:
        named[f"{domain}_csv"] = _scanned(domain)
        named[f"{domain}_valid"] = _valid(domain)
        named[f"{domain}_rejected"] = _rejected(domain, V2)
        named[f"{domain}_rejected_strict"] = _rejected(domain, V2_STRICT)
        named[f"dq_{domain}"] = _report(domain, V2)
        named[f"{domain}_stage"] = _staged(domain, V2)
    named["orders_stream"] = _streamed
    named["process_log"] = _process_log
    named["row_counts"] = _row_counts

    for check in validate.OFFENDERS:
        name = f"v1_{check}" if check == "stock_mismatch" else check
        named[name] = _offenders(check, V1 if check == "stock_mismatch" else V2)
    named["check_counts"] = _counts(V2)
    named["validation_results"] = lambda spark, d: plain(_results(spark, d, V2))
    named["validation_gate"] = _gate(V2)
    named["validation_log"] = _validation_log

    named["enriched_orders"] = _fact(V2)
    named["enriched_orders_spread"] = _fact(V2, FINE_SPREAD)
    named["customer_analytics"] = lambda spark, d: plain(_customers(spark, d, V2))
    named["product_analytics"] = lambda spark, d: plain(_products(spark, d, V2))
    named["customer_analytics_spread"] = lambda spark, d: plain(
        _customers(spark, d, V2, policy=FINE_SPREAD)
    )

    named["analytics_summary"] = _summary(V2)
    named["seasonal_analysis"] = lambda spark, d: plain(
        summary.seasonal_analysis(sample_fact(spark, d, V2)[0])
    )
    named["segment_analysis"] = lambda spark, d: plain(
        summary.segment_analysis(_customers(spark, d, V2))
    )
    named["category_analysis"] = lambda spark, d: plain(
        summary.category_analysis(_products(spark, d, V2))
    )

    for name in ("orders", "customers", "products"):
        table = f"{name}_target"
        named[f"scd2_{name}_first"] = _history(table, V2, load_twice=False)
        named[f"scd2_{name}_second"] = _history(table, V2, load_twice=True)
    named["scd2_customers_closed"] = _history("customers_target", V2, True, closed=True)

    for domain in schemas.DOMAINS:
        named[f"v1_{domain}_rejected"] = _rejected(domain, V1)
    named["v1_bad_email_phone"] = _report("customers", V1)
    named["v1_customers_stage"] = _staged("customers", V1)
    named["v1_process_log"] = _v1_log
    named["v1_appended_results"] = _v1_appended_results
    named["v1_check_counts"] = _counts(V1)
    named["v1_validation_results"] = lambda spark, d: plain(_results(spark, d, V1))
    named["v1_validation_gate"] = _gate(V1)
    named["v1_enriched_orders"] = _fact(V1)
    named["v1_customer_analytics"] = lambda spark, d: rounded(
        plain(_customers(spark, d, V1)), 3, "total_profit_generated"
    )
    named["v1_product_analytics"] = lambda spark, d: rounded(
        plain(_products(spark, d, V1)), 3, "total_profit"
    )
    named["v1_analytics_summary"] = _summary(V1)
    named["v1_seasonal_analysis"] = lambda spark, d: plain(
        summary.seasonal_analysis(sample_fact(spark, d, V1)[0])
    )
    for name in ("orders", "customers", "products"):
        named[f"v1_scd2_{name}"] = _history(f"{name}_target", V1, True, closed=True)
    return named
