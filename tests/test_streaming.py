from __future__ import annotations

import pytest
from cartwright.config import v2_rules
from cartwright.sources.sample import sample_rules
from cartwright.streaming.ingest import EpochStore, checkpoint_root, ingest_available
from test_files import line, put

RULES = sample_rules(v2_rules())


def run(store, source, **options):
    query = ingest_available(store, str(source), RULES, **options)
    query.awaitTermination(120)
    assert query.exception() is None


def test_each_file_is_loaded_once(spark, tmp_path):
    source = tmp_path / "in"
    store = EpochStore(spark, str(tmp_path / "out"), "orders")
    options = {"checkpoint": str(tmp_path / "cp")}
    put(source, "a.csv", line("1"), line("2", amount="0"))
    run(store, source, **options)
    assert [r.order_id for r in store.stage(RULES).collect()] == ["1"]
    assert [r.order_id for r in store.errors(RULES).collect()] == ["2"]

    run(store, source, **options)  # nothing new, so nothing is written
    assert store.stage(RULES).count() == 1
    assert store.log().count() == 1

    put(source, "b.csv", line("3"))
    run(store, source, **options)
    assert sorted(r.order_id for r in store.stage(RULES).collect()) == ["1", "3"]
    assert [r.order_id for r in store.latest(RULES).collect()] == ["3"]
    log = {r.epoch: r for r in store.log().collect()}
    assert (log[0].total_records, log[0].invalid_records) == (2, 1)
    assert (log[1].total_records, log[1].status) == (1, "SUCCESS")


def test_epoch_without_valid_or_rejected_rows(spark, tmp_path):
    source = tmp_path / "in"
    store = EpochStore(spark, str(tmp_path / "out"), "orders")
    put(source, "a.csv", line("1", amount=""))
    run(store, source, checkpoint=str(tmp_path / "cp"))
    assert store.stage(RULES).count() == store.errors(RULES).count() == 0
    assert store.latest(RULES).count() == 0
    assert store.log().first().total_records == 1
    assert store.errors(RULES).columns[-3:] == ["epoch", "error_reason", "error_timestamp"]


def test_replayed_epoch_leaves_one_copy(spark, tmp_path):
    store = EpochStore(spark, str(tmp_path / "out"), "orders")
    source = tmp_path / "in"
    put(source, "a.csv", line("1"))
    for attempt in ("cp1", "cp2"):  # a lost checkpoint replays epoch 0
        run(store, source, checkpoint=str(tmp_path / attempt))
    assert store.stage(RULES).count() == 1
    assert store.log().count() == 1


def test_files_are_archived_by_a_later_run(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "archive"
    store = EpochStore(spark, str(tmp_path / "out"), "orders")
    options = {"checkpoint": str(tmp_path / "cp"), "archive_dir": str(archive)}
    for name in ("a.csv", "b.csv", "c.csv"):
        put(source, name, line(name[0]))
        run(store, source, files_per_trigger=1, **options)
    assert store.stage(RULES).count() == 3
    assert "a.csv" in {p.name for p in archive.rglob("*.csv")}


def test_checkpoints_go_to_the_shared_folder_of_the_session(spark, tmp_path):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    store = EpochStore(spark, str(tmp_path / "out"), "orders")
    put(tmp_path / "in", "a.csv", line("1"))
    run(store, tmp_path / "in")
    assert store.stage(RULES).count() == 1


def test_without_a_shared_folder_a_checkpoint_must_be_named():
    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        checkpoint_root(Session())
