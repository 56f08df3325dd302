"""Shapes of the physical plans: what is read, what is shuffled, and how often."""

from __future__ import annotations

import re

import pytest
from cartwright.config import v2_rules
from cartwright.operators import enrich, joins, quality, scd2, stage, summary, validate
from cartwright.operators.joins import SkewPolicy, spread_join
from cartwright.plans import catalog
from cartwright.plans.catalog import sample_stages
from cartwright.sources import sample
from cartwright.sources.sample import INPUTS, most_rows, sample_rules
from cartwright.sources.tables import rows_of

RULES = sample_rules(v2_rules())


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    home = tmp_path_factory.mktemp("stages")
    tables = {}
    for name, df in sample_stages(spark, data, RULES).items():
        df.write.parquet(str(home / name))
        tables[name] = spark.read.parquet(str(home / name))
    enrich.enriched_orders(tables, RULES).write.parquet(str(home / "fact"))
    tables["fact"] = spark.read.parquet(str(home / "fact"))
    return tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def shuffles(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single|Round)", plan(df)))


def scanned(df):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))


def test_quality_report_is_one_scan_and_one_row_shuffled(stages):
    report = quality.quality_report(stages["orders"], "orders", RULES)
    assert len(scanned(report)) == 1
    assert scanned(report)[0] == "order_id:string,customer_id:string,order_amount:decimal(10,2)"
    assert shuffles(report) == 1


def test_validity_is_pushed_into_the_scan(stages):
    raw = stages["orders"]
    text = plan(quality.accept(raw, "orders", RULES))
    assert "IsNotNull(order_id)" in text and "GreaterThan(order_amount" in text


def test_stage_rows_need_no_shuffle(stages):
    for domain in ("orders", "customers", "products", "inventory", "shipping"):
        assert shuffles(stage.accept_and_derive(stages[domain], domain, RULES)) == 0


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_checks_read_each_stage_once_and_join_nothing(stages):
    for stock_check in (False, True):
        counts = validate.check_counts(stages, RULES, stock_check=stock_check)
        assert len(scanned(counts)) == 5
        for columns in scanned(counts):
            assert len(re.findall(r"\w+:", columns)) <= 5, columns
        assert "Join" not in plan(counts)
        # One shuffle for all keys of all stages, one for the single row of sums.
        assert shuffles(counts) == 2
        assert "partial_sum" in plan(counts)


def test_report_over_large_sides_reads_its_columns_once(spark, data, no_broadcast):
    """Without hot keys the joins are plain: columns are pruned and each raw table is read as often as used."""
    report = catalog.queries()["seasonal_analysis"](spark, data)
    assert "__cell" not in optimized(report)
    assert len(scanned(report)) <= 9
    read = {name for columns in scanned(report) for name in re.findall(r"([a-z]_\w+):", columns)}
    assert not read & {"o_orderpriority", "o_clerk", "o_shippriority", "o_comment", "p_name", "p_brand", "c_name", "c_address"}
    orders = max((c for c in scanned(report) if "o_orderkey" in c), key=len)
    assert len(orders.split(":")) - 1 <= 5


def test_row_counts_come_from_the_writes(spark, data):
    assert len(scanned(catalog.queries()["row_counts"](spark, data))) <= 8


def test_sketch_of_heavy_keys_reads_each_frame_once(stages, monkeypatch):
    asked = []
    monkeypatch.setattr(enrich, "heavy_keys", lambda frames, policy: asked.append(frames) or {})
    enrich.join_profile(stages, SkewPolicy(always_spread=True))
    assert {name: keys for name, (_, keys) in asked[0].items()} == {
        "orders": ["customer_id", "order_id", "product_id"],
        "customers": ["customer_id"],
        "products": ["product_id"],
        "inventory": ["product_id"],
        "shipping": ["order_id"],
    }
    monkeypatch.undo()
    found = enrich.join_profile(stages, SkewPolicy(always_spread=True))
    counted = dict(stages["orders"].groupBy("customer_id").count().orderBy("count", ascending=False).limit(5).collect())
    heavy = found["orders", "customer_id"]
    assert all(heavy[key] == n for key, n in counted.items())


def test_only_hot_keys_are_placed(spark, no_broadcast):
    left = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS k", "id AS a")
    right = spark.range(3000).selectExpr("if(id % 30 = 0, 'hot', cast(id AS string)) AS k", "id AS b")
    joined = spread_join(left, right, "k", policy=SkewPolicy(rows_per_cell=10_000))
    assert "__cell_l_at" in optimized(joined) and joined.count() == 1000 * 100 + 2000
    plain = spread_join(left, right, "k", policy=SkewPolicy(rows_per_cell=200_000))
    assert "__cell" not in optimized(plain) and plain.count() == 1000 * 100 + 2000


def test_small_dimensions_are_broadcast_and_orders_never_shuffled(stages):
    fact = enrich.enriched_orders(stages, RULES)
    assert shuffles(fact) == 0
    assert plan(fact).count("BroadcastHashJoin") == 4


def test_large_dimensions_shuffle_the_fact_once_per_key(stages):
    policy = SkewPolicy(always_spread=True)
    text = optimized(enrich.enriched_orders(stages, RULES, policy))
    # Four joins with the dimensions on placed keys; products and inventory share one placement.
    placed = re.findall(r"Join LeftOuter, .*__cell_l_at", text)
    assert len(placed) == 4
    assert len(re.findall(r"__cell_r1_at#\d+ = __cell_r1_at", text)) == 2


def test_analytics_read_only_their_columns(stages):
    fact = stages["fact"]
    report = summary.analytics_summary(fact, RULES)
    assert len(scanned(report)) == 1 and len(scanned(report)[0].split(":")) - 1 <= 7
    customers = enrich.customer_analytics(fact, stages["customers"], RULES)
    assert all(len(re.findall(r"\w+:", s)) <= 22 for s in scanned(customers))
    assert "partial_count" in plan(customers)
    assert len(scanned(summary.seasonal_analysis(fact))[0].split(":")) - 1 == 3


def test_history_update_reads_the_target_once(spark, stages, tmp_path):
    history = scd2.HISTORIES["orders_target"]
    batch = history.batch(stages["fact"])
    path = str(tmp_path / "state")
    scd2.stamp_current(batch, RULES).write.parquet(path)
    state = scd2.scd2_apply(spark.read.parquet(path), batch, "order_id", RULES)
    assert len(scanned(state)) == 3  # target, batch keys, batch
    assert "order_id:string" in scanned(state)


def test_order_history_stores_the_fact_alone_and_passes_no_closed_rows(spark, data, monkeypatch):
    labels, targets = [], []
    store, apply = catalog.stored, scd2.scd2_apply
    monkeypatch.setattr(catalog, "stored", lambda df, label: labels.append(label) or store(df, label))
    monkeypatch.setattr(scd2, "scd2_apply", lambda target, *rest: targets.append(target) or apply(target, *rest))
    for name in ("scd2_orders_second", "v1_scd2_orders"):
        catalog.queries()[name](spark, data)
    assert labels == ["fact", "fact"]
    assert all("Union" not in optimized(target) for target in targets)


def test_groups_of_the_checks_are_narrow(stages):
    """A task holds a row of every group it meets: numbers of eight bytes, no more of them than one kind needs."""
    for stock_check, most in ((False, 6), (True, 8)):
        text = optimized(validate.check_counts(stages, RULES, stock_check=stock_check))
        group = next(line for line in text.splitlines() if re.search(r"Aggregate \[kind", line))
        assert len(re.findall(r"\bsum\(", group)) <= most
        assert "decimal(20,2)" not in text


def test_rows_of_large_stages_are_grouped_in_tasks_of_a_bounded_size(stages, monkeypatch):
    def dealt(counts):
        return [int(n) for n in re.findall(r"RepartitionByExpression \[(?:[^\]]*)\], (\d+)", optimized(counts))]

    for stock_check in (False, True):
        plain = validate.check_counts(stages, RULES, stock_check=stock_check)
        assert not dealt(plain)
        for part in (20_000, 5_000):
            monkeypatch.setattr(validate, "TASK_BYTES", part)
            counts = validate.check_counts(stages, RULES, stock_check=stock_check)
            # Four entries of each order, so four times the bytes.
            assert -(-4 * joins.bytes_read(stages["orders"]) // part) in dealt(counts)
            assert sorted(counts.collect()) == sorted(plain.collect())
        monkeypatch.undo()


def test_rows_with_a_frequent_key_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(validate, "TASK_BYTES", 2_000)
    shipping = spark.range(1000).selectExpr("'n/a' AS shipping_id", "cast(id AS string) AS order_id")
    entries = [validate._Entry(validate._ORDER, "order_id", {"shipping": 1})]
    parts = validate._dealt(shipping, "shipping", entries).selectExpr("spark_partition_id() AS part").groupBy("part").count()
    rows = [row["count"] for row in parts.collect()]
    assert len(rows) == 4 and max(rows) < 350


def test_stage_of_unknown_size_is_not_dealt(spark):
    rows = spark.createDataFrame([("s", "o")], "shipping_id string, order_id string").rdd.toDF()
    rows = rows.union(spark.createDataFrame(rows.rdd, rows.schema))
    entries = [validate._Entry(validate._ORDER, "order_id", {"shipping": 1})]
    assert joins.bytes_read(rows) == 0
    assert validate._dealt(rows, "shipping", entries) is rows


def test_tasks_group_a_bounded_number_of_entries_however_few_bytes_rows_take(spark, monkeypatch, tmp_path):
    spark.range(20_000).selectExpr("cast(id AS string) AS product_id").coalesce(1).write.parquet(str(tmp_path / "products"))
    products = spark.read.parquet(str(tmp_path / "products"))
    rows = rows_of({"products": products})
    assert rows == {"products": 20_000}
    entries = [validate._Entry(validate._PRODUCT, "product_id", {"products": 1})] * 4
    monkeypatch.setattr(validate, "TASK_ENTRIES", 10_000)
    assert joins.bytes_read(products) * 4 < validate.TASK_BYTES
    dealt = validate._dealt(products, "products", entries, rows["products"])
    parts = [row["count"] for row in dealt.selectExpr("spark_partition_id() AS part").groupBy("part").count().collect()]
    assert len(parts) == 8 and 4 * max(parts) < 1.1 * validate.TASK_ENTRIES


@pytest.mark.parametrize("name", ["v1_validation_gate", "v1_validation_results", "validation_gate"])
def test_validation_queries_deal_by_rows(spark, data, monkeypatch, name):
    query, rows = catalog.queries()[name], most_rows(spark, data)
    plain = sorted(query(spark, data).collect())
    assert all(rows[domain] >= stage.count() for domain, stage in sample_stages(spark, data, RULES).items())
    assert rows == {domain: spark.table(tables[0]).count() for domain, tables in INPUTS.items()}
    monkeypatch.setattr(validate, "TASK_ENTRIES", 100)
    dealt = query(spark, data)
    tasks = [int(n) for n in re.findall(r"RepartitionByExpression \[(?:[^\]]*)\], (\d+)", optimized(dealt))]
    per_row = {"orders": 4, "customers": 1, "products": 4, "inventory": 1, "shipping": 1}
    assert tasks == [-(-rows[domain] * n // 100) for domain, n in per_row.items()]
    assert sorted(dealt.collect()) == plain


@pytest.mark.parametrize("name", ["check_counts", "v1_check_counts", "v1_validation_gate", "validation_gate"])
def test_validation_queries_deal_lineitem_before_the_views_group_it(spark, data, monkeypatch, name):
    query, rows = catalog.queries()[name], most_rows(spark, data)["inventory"]
    plain = sorted(query(spark, data).collect())
    monkeypatch.setattr(sample, "TASK_ROWS", 1000)
    dealt = query(spark, data)
    tasks = dict(re.findall(r"RepartitionByExpression \[(l_\w+)#[^\]]*\], (\d+)", optimized(dealt)))
    assert rows > 1000 and tasks == dict.fromkeys(["l_orderkey", "l_partkey"], str(-(-rows // 1000)))
    assert sorted(dealt.collect()) == plain


def test_orders_view_groups_and_joins_lineitem_where_it_was_dealt(spark, data, no_broadcast, monkeypatch):
    plain = sample_stages(spark, data, RULES, ("orders",))["orders"]
    monkeypatch.setattr(sample, "TASK_ROWS", 1000)
    rows = most_rows(spark, data)
    view = sample_stages(spark, data, RULES, ("orders",), rows)["orders"]
    # Lineitem by its own number of tasks and orders to the same, no exchange between grouping and join.
    assert shuffles(view) == 2
    groups = -(-rows["inventory"] // 1000)
    assert len(re.findall(rf"hashpartitioning\(\w_orderkey#\d+L?, {groups}\)", plan(view))) == 2
    assert view.rdd.getNumPartitions() == groups
    assert sorted(map(str, view.collect())) == sorted(map(str, plain.collect()))


def test_view_without_rows_given_reads_its_tables_as_they_lie(spark, data, monkeypatch):
    monkeypatch.setattr(sample, "TASK_ROWS", 1000)
    for frame in sample.raw_views(spark, data).values():
        assert "RepartitionByExpression" not in optimized(frame)
