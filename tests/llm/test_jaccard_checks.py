"""The sketch check of the n-gram Jaccard join loses no link."""

import numpy as np
import pandas as pd
import pytest

from cartwright.llm import jaccard_join as join


def jaccard(a, b):
    common = len(np.intersect1d(a, b))
    return 100 * common, len(a) + len(b) - common


@pytest.mark.parametrize("percent", [80, 90])
def test_sets_that_link_pass_the_check(percent):
    rng = np.random.default_rng(percent)
    passed = 0
    for _ in range(400):
        size = int(rng.integers(1, 3000))
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        changed = int(rng.integers(0, max(2, len(a) // 5)))
        b = np.unique(np.append(a[changed:], rng.integers(0, 2**63, changed // 2, dtype=np.uint64)))
        if not len(b):
            continue
        common, union = jaccard(a, b)
        if common >= percent * union:
            passed += 1
            assert join.may_link((len(a), join.sketch(a)), (len(b), join.sketch(b)), percent)
    assert passed > 50


def test_unrelated_sets_of_like_size_fail_the_check():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**63, 1000, dtype=np.uint64) for _ in "ab")
    assert not join.may_link((1000, join.sketch(a)), (1000, join.sketch(b)), 80)


def listed(rows, size):
    frame = pd.DataFrame(rows, columns=["key", "doc_id"])
    batches = [frame[k : k + size] for k in range(0, len(frame), size)]
    found = pd.concat(list(join._holders(iter(batches))))
    return {(tuple(ids), check) for ids, check in zip(found["ids"], found["check"])}


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_holders_of_a_key_are_listed_whole_across_batches(size, monkeypatch):
    monkeypatch.setattr(join, "CHECKED", 3)
    rows = [(1, 5), (2, 1), (2, 4), (2, 4), (3, 7), (3, 7), (4, 1), (4, 2), (4, 3), (4, 6), (4, 9)]
    wide = {((1, other), False) for other in (2, 3, 6, 9)}
    assert listed(rows, size) == {((1, 4), True)} | wide
    assert listed(rows + [(5, 1), (5, 2), (5, 3)], size) == {((1, 4), True), ((1, 2, 3), True)} | wide


@pytest.mark.parametrize("size", [1, 2, 100])
def test_checked_edges_connect_what_may_link(size):
    rng = np.random.default_rng(2)
    a, b = (np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64)) for _ in "ab")
    row = {1: a, 2: b, 3: a[5:], 4: b[5:], 8: a[9:]}
    rows = [(7, i, len(s), join.sketch(s)) for i, s in row.items()]
    rows += [(9, i, len(s), join.sketch(s)) for i, s in row.items() if i < 3]
    frame = pd.DataFrame(rows, columns=["holders", "doc_id", "n_shingles", "sketch"])
    batches = [frame[k : k + size] for k in range(0, len(frame), size)]
    found = pd.concat(list(join._check(80)(iter(batches))))
    edges = set(found.itertuples(index=False, name=None))
    assert {frozenset(e) for e in edges} == {frozenset(e) for e in [(1, 3), (2, 4), (1, 8)]}
