"""Hard negatives against a brute-force version."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import types as T

from cartwright.llm import hard_negatives
from cartwright.llm.hard_negatives import Mining, mine

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        # Names that the operator uses inside.
        T.StructField("cell", T.StringType()),
        T.StructField("vector", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("slot", T.StringType()),
    ]
)
SMALL = Mining(positives=3, negatives=4, every=5)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "a", "b", "c", "d") for row in rows], SCHEMA)


def brute(rows, how):
    seen = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        seen.add((vec_id, label, tuple(math.floor(how.scale * x) for x in vector)))
    # Of rows that share an anchor's id the smallest is the anchor.
    anchors = {}
    for row in sorted(seen, key=lambda r: (r[0], r[1], b"".join(x.to_bytes(4, "little", signed=True) for x in r[2]))):
        if row[0] % how.every == 0:
            anchors.setdefault(row[0], row)
    out = []
    for vec_id, label, vector in anchors.values():
        scored = {
            (-sum(a * b for a, b in zip(vector, other)), other_id, other_label == label)
            for other_id, other_label, other in seen
            if other_id != vec_id and len(other) == len(vector)
        }
        same = sorted({(s, i) for s, i, alike in scored if alike})[: how.positives]
        for down, positive in same:
            found = sorted(
                (s, i) for s, i, alike in scored if not alike and how.least * -down <= 100 * -s <= 100 * -down
            )
            found = sorted(set(found))[: how.negatives]
            out += [(vec_id, positive, at + 1, i, -down, -s) for at, (s, i) in enumerate(found)]
    return sorted(out)


def mined(spark, rows, how=SMALL):
    return sorted(tuple(row) for row in mine(frame(spark, rows), how).collect())


def vectors(n, dim, labels, seed, digits=1):
    rng = random.Random(seed)
    return [(i, [round(rng.gauss(0.3, 0.4), digits) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("digits", [1, 6])
def test_equals_brute_force(spark, digits):
    """Coarse components give many equal scores, so the order by id decides."""
    rows = vectors(160, 4, 3, 5, digits)
    expected = brute(rows, SMALL)
    assert len(expected) > 100
    assert mined(spark, rows) == expected


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = vectors(120, 3, 2, 8)
    expected = brute(rows, SMALL)
    monkeypatch.setattr(hard_negatives, "ROWS_PER_CELL", 5)
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_CELL", 3)
    monkeypatch.setattr(hard_negatives, "_SCORES", 7)
    assert mined(spark, rows) == expected


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = vectors(150, 4, 3, 2)
    rows = [(i, [0.5, 0.5, 0.5, 0.5] if i % 3 else v, label) for i, v, label in rows]
    assert mined(spark, rows) == brute(rows, SMALL)


def test_odd_rows(spark):
    """NULLs, values that aren't finite, other lengths, rows that repeat or share an id, few positives."""
    rows = vectors(40, 3, 2, 3)
    rows += rows[:20] * 3
    rows += [(10, [0.1, 0.2, 0.3], 1), (10, [0.1, 0.2, 0.4], 0), (7, [1.0, 1.0, 1.0], 0)]
    rows += [(None, [1.0, 1.0, 1.0], 0), (100, None, 0), (101, [1.0, 1.0, 1.0], None)]
    rows += [(102, [1.0, None, 1.0], 0), (103, [math.nan, 1.0, 1.0], 0), (105, [math.inf, 1.0, 1.0], 0)]
    rows += [(110, [], 0), (111, [], 0), (112, [], 1), (115, [0.5, 0.5], 9), (116, [0.5, 0.6], 9), (117, [0.5, 0.5], 8)]
    rows += [(-5, [0.9, 0.9, 0.9], 1), (120, [0.4] * 2000, 5), (121, [0.4] * 2000, 5), (122, [0.4] * 2000, 6)]
    expected = brute(rows, SMALL)
    assert {row[0] for row in expected} >= {-5, 10, 115, 120}
    assert mined(spark, rows) == expected


def test_negative_and_large_scores(spark):
    """Below zero no window holds a score; products beyond 2^53 stay exact."""
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.9, 0.0], 1), (3, [-1.0, 0.0], 1)]
    assert mined(spark, rows) == brute(rows, SMALL) == []
    big = [(i, [60000.0 + i / 256, 59999.0 + (i % 3) / 256], i % 2) for i in range(20)]
    assert mined(spark, big) == brute(big, SMALL) != []


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 0)]) == []


def test_lists_stay_short(spark):
    """What leaves a cell is bounded by its anchors and slots, not by the rows that match."""
    best = hard_negatives._Best(2, 3, 4)
    import numpy as np

    for start in range(0, 1000, 50):
        ids = np.arange(start, start + 50)
        best.add(ids % 2, ids % 3, np.full(50, 7), ids)
    table = best.table(np.array([10, 20]))
    assert table.num_rows == 2 * 3 * 4
    assert max(table.column("vec_id").to_pylist()) < 24
