"""The whole run from CSV files to reports, twice, and in both generations."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from cartwright import schemas
from cartwright.config import v1_rules, v2_rules
from cartwright.operators import enrich, stage, validate
from cartwright.operators.scd2 import HISTORIES
from cartwright.plans import pipeline
from cartwright.plans.catalog import plain
from cartwright.plans.pipeline import Folders, Pipeline
from cartwright.sinks.landing import land
from cartwright.sources.files import scan_csv
from cartwright.sources.sample import raw_view, sample_rules
from cartwright.sources.tables import TableStore


def deliver(spark, data, folder, domain, when="true"):
    rows = raw_view(spark, data, domain).filter(when)
    options = {"header": True, "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    rows.coalesce(2).write.mode("append").options(**options).csv(folder)


def bag(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def setup(spark, data, tmp_path, database, rules):
    folders = {
        d: Folders(str(tmp_path / d / "source"), str(tmp_path / d / "archive"))
        for d in schemas.DOMAINS
    }
    for domain in schemas.DOMAINS:
        deliver(spark, data, folders[domain].source, domain)
    return Pipeline(TableStore(spark, database), folders, str(tmp_path / "store"), rules)


def test_run_equals_transforms_and_a_second_run_extends_history(spark, data, tmp_path, database):
    rules = sample_rules(v2_rules())
    first = setup(spark, data, tmp_path, database, rules)
    totals = first.run()
    tables = first.tables
    stages = {
        d: stage.stage_rows(raw_view(spark, data, d), d, rules) for d in schemas.DOMAINS
    }
    for domain in schemas.DOMAINS:
        assert bag(plain(tables.read(f"{domain}_stage"))) == bag(plain(stages[domain])), domain
        errors = stage.error_rows(raw_view(spark, data, domain), domain, rules)
        assert bag(plain(tables.read(f"{domain}_errors"))) == bag(plain(errors)), domain
    fact = enrich.enriched_orders(stages, rules)
    assert bag(plain(tables.read("enriched_orders"))) == bag(plain(fact))
    results = validate.validation_results(stages, rules)
    assert bag(plain(tables.read("validation_results"))) == bag(plain(results))
    assert totals["total_orders"] == fact.count()
    for table in ("seasonal_analysis", "segment_analysis", "category_analysis"):
        assert tables.read(table).count() > 0

    log = {r.task: r for r in tables.read("process_log").collect()}
    assert len(log) == 8
    assert log["orders_stage_load"].total_records == 1500
    assert log["orders_stage_load"].valid_records == 1474
    assert log["orders_stage_load"].archived_files >= 1
    assert log["orders_stage_load"].status == "SUCCESS_WITH_WARNINGS"
    assert log["data_enrichment"].status == "SUCCESS"
    assert log["final_merge_operation"].total_records == totals["total_orders"]
    assert log["data_validation"].valid_records == 0

    for table, history in HISTORIES.items():
        rows = first.history(table).read()
        assert rows.filter("NOT is_current").count() == 0
        assert rows.columns == [*history.columns, "effective_date", "expiry_date", "is_current"]

    # The source directories are empty now; a second delivery brings part of the orders again.
    for domain in schemas.DOMAINS:
        when = "order_date >= DATE'2000-07-01'" if domain == "orders" else "true"
        folder = str(tmp_path / domain / "source2")
        deliver(spark, data, folder, domain, when)
    folders = {
        d: Folders(str(tmp_path / d / "source2"), str(tmp_path / d / "archive"))
        for d in schemas.DOMAINS
    }
    before = {t: first.history(t).read().count() for t in HISTORIES}
    later = sample_rules(v2_rules())
    later = type(later)(as_of=dt.date(2001, 8, 3), now=dt.datetime(2001, 8, 3, 9), batch_id="b2")
    second = Pipeline(tables, folders, str(tmp_path / "store"), later)
    second.run()
    for table, history in HISTORIES.items():
        rows = second.history(table).read()
        batch = tables.read(history.source)
        assert rows.count() == before[table] + batch.count(), table
        current = rows.filter("is_current").groupBy(history.key).count()
        closed = rows.filter("NOT is_current")
        assert closed.count() > 0
        assert closed.filter("expiry_date <> DATE'2001-08-03'").count() == 0
        # A non-null key of the batch is current with exactly its batch rows.
        expected = batch.filter(f"{history.key} IS NOT NULL").groupBy(history.key).count()
        assert expected.exceptAll(current).count() == 0, table
    assert tables.read("process_log").count() == 16


def test_older_rules_append_results_and_log_nulls(spark, data, tmp_path, database):
    rules = sample_rules(v1_rules())
    run = setup(spark, data, tmp_path, database, rules)
    run.load_all()
    gate = run.validate()
    assert gate["overall_status"] == "FAIL"
    run.validate()
    assert run.tables.read("validation_results").count() == 22
    run.enrich()
    run.merge()
    assert not run.tables.exists("customers_errors")
    log = {r.task: r for r in run.tables.read("process_log").collect()}
    assert log["data_validation"].status is None
    assert log["data_enrichment"].status == "SUCCESS"
    assert log["data_enrichment"].total_records is None
    assert log["final_merge_operation"].archived_files is None
    assert "profit_margin_percentage" in run.tables.read("analytics_summary").columns


def test_empty_source_overwrites_the_stage_with_nothing(spark, data, tmp_path, database):
    rules = sample_rules(v2_rules())
    run = setup(spark, data, tmp_path, database, rules)
    assert run.load("products").counts["total_records"] == 200
    assert run.tables.read("products_stage").count() == 191
    again = run.load("products")
    assert again.counts["total_records"] == 0 and again.archived == 0
    assert run.tables.read("products_stage").count() == 0
    assert len(list((tmp_path / "store" / "landing" / "products").iterdir())) == 1
    assert run.tables.read("products_errors").count() == 7


def test_weightless_parcels_are_rejected_not_fatal(spark, tmp_path):
    columns = [part.split()[0] for part in schemas.SHIPPING.replace("10,2", "").replace("8,2", "").split(",")]
    row = dict.fromkeys(columns, "x") | {
        "shipping_id": "s1", "shipping_cost": "1.00", "package_weight": "0", "insurance_value": "0",
    }
    (tmp_path / "in").mkdir()
    text = ",".join(columns) + "\n" + ",".join(row[c] for c in columns) + "\n"
    (tmp_path / "in" / "a.csv").write_text(text)
    rules = sample_rules(v2_rules())
    raw = scan_csv(spark, "shipping", str(tmp_path / "in"))
    counts = land(raw, "shipping", rules, str(tmp_path / "out"))
    assert (counts["valid_records"], counts["invalid_records"]) == (0, 1)


def test_create_refuses_an_existing_table(spark, database):
    store = TableStore(spark, database)
    store.create(spark.range(1), "t")
    assert store.exists("t") and not store.exists("u")
    with pytest.raises(Exception, match="(?i)exist"):
        store.create(spark.range(1), "t")


def test_pinned_rules_share_one_clock(spark):
    pinned = v2_rules().pinned(spark)
    assert pinned.as_of == pinned.now.date()
    assert pinned.batch() == pinned.now.strftime("%Y%m%d_%H%M%S")
    assert v2_rules(as_of=dt.date(2001, 1, 1)).pinned(spark).as_of == dt.date(2001, 1, 1)


def test_load_that_cannot_be_archived_leaves_no_trace(spark, data, tmp_path, database):
    run = setup(spark, data, tmp_path, database, sample_rules(v2_rules()))
    run.load("products")
    before = run.tables.read("products_errors").count()
    taken = next((tmp_path / "products" / "archive").glob("*.csv"))
    (tmp_path / "products" / "source" / taken.name).write_text(taken.read_text())
    for _ in range(2):
        with pytest.raises(FileExistsError):
            run.load("products")
        assert run.tables.read("products_errors").count() == before
        assert len(list((tmp_path / "store" / "landing" / "products").iterdir())) == 1


def test_a_failing_domain_does_not_hide_the_others(spark, data, tmp_path, database, monkeypatch):
    run = setup(spark, data, tmp_path, database, sample_rules(v2_rules()))
    load = run.load

    def fail(domain):
        if domain == "inventory":
            raise OSError("lost")
        return load(domain)

    monkeypatch.setattr(run, "load", fail)
    with pytest.raises(OSError, match="lost"):
        run.load_all()
    logged = {row.task for row in run.tables.read("process_log").collect()}
    assert logged == {f"{d}_stage_load" for d in schemas.DOMAINS if d != "inventory"}


@pytest.mark.parametrize("limit", ["-1", "10MB", "1g"])
def test_fact_columns_do_not_depend_on_sizes(spark, data, limit):
    rules = sample_rules(v2_rules())
    stages = {d: stage.stage_rows(raw_view(spark, data, d), d, rules) for d in schemas.DOMAINS}
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        names = enrich.enriched_orders(stages, rules).columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert names[:3] == ["order_id", "product_id", "customer_id"]
    assert names.index("first_name") < names.index("product_name") < names.index("reorder_level")
    assert names.index("reorder_level") < names.index("carrier")


def test_load_stopped_before_archiving_leaves_one_copy_of_the_rejects(spark, data, tmp_path, database, monkeypatch):
    run = setup(spark, data, tmp_path, database, sample_rules(v2_rules()))

    def stop(*_):
        raise OSError("stopped")

    monkeypatch.setattr(pipeline, "archive_csv", stop)
    for _ in range(2):
        with pytest.raises(OSError, match="stopped"):
            run.load("products")
    monkeypatch.undo()
    run.load("products")
    errors = stage.error_rows(raw_view(spark, data, "products"), "products", run.rules)
    assert bag(plain(run.tables.read("products_errors"))) == bag(plain(errors))
    # Other files in the same batch add to them.
    deliver(spark, data, run.folders["products"].source, "products")
    run.load("products")
    assert run.tables.read("products_errors").count() == 2 * errors.count()
    assert run.tables.read("products_errors").columns == errors.columns
