"""Repeated passages go up to both edges, however short they are."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartwright.llm import common, line_dedup, span_dedup

WORDS = [f"w{i}" for i in range(400)]


def sentence(rng, n=9):
    return " ".join(rng.choices(WORDS, k=n)) + "."


def brute_lines(rows):
    """Lines left of each text: of equal pairs of lines the first stays."""
    firsts, out = {}, {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for at in range(len(lines) - 1 - (not lines[-1])):
            pair = lines[at], lines[at + 1]
            if not any(map(str.strip, pair)):
                continue
            first = firsts.setdefault(pair, (doc_id, at))
            if first[0] != doc_id or at > first[1] + 1:
                gone |= {at, at + 1}
        out[doc_id] = "\n".join(line for at, line in enumerate(lines) if at not in gone)
    return out


def test_every_line_of_a_repeated_passage_goes(make_docs, monkeypatch):
    rng = random.Random(1)
    passages = [[sentence(rng) for _ in range(size)] for size in (2, 2, 3, 3, 5, 8, 14)]
    rows = []
    for passage in passages:
        for _ in range(8):
            own = [sentence(rng) for _ in range(rng.randrange(2, 12))]
            at = rng.randrange(1, len(own))
            rows.append((len(rows), "\n".join(own[:at] + passage + own[at:])))
    passed = {tuple(p): i for i, p in enumerate(passages)}
    assert len(passed) == len(passages)
    rows += [(100, "a\n" * 9), (101, "a\na\na"), (102, "\n\n\n" + passages[0][0] + "\n"), (103, passages[0][0] + "\n")]
    for limit in (400_000, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
        cleaned = {r.doc_id: r for r in line_dedup.remove_repeated_lines(make_docs(rows)).collect()}
        assert {i: r.text for i, r in cleaned.items()} == brute_lines(rows)
        for i, passage in enumerate(passages):
            assert all(cleaned[8 * i + k].line_dedup.n_removed == len(passage) for k in range(1, 8))


def test_both_edges_of_a_passage_go(make_docs):
    rng = random.Random(2)
    rows = []
    for sizes in ((15, 3, 2), (2, 3, 15), (9, 9, 2, 1), (12, 1, 1, 1, 12, 4)):
        passage = [sentence(rng, n) for n in sizes]
        first = len(rows)
        for k in range(3):
            own = [sentence(rng, rng.randrange(9, 14)) for _ in range(4)]
            rows.append((first + k, " ".join(own[:2] + passage + own[2:]), len(passage) if k else 0))
    rows += [(50, "Too short.", 0), (51, "Too  short.", 1), (52, "Too short. Not the same.", 0)]
    cleaned = {r.doc_id: r for r in span_dedup.remove_repeated_spans(make_docs([r[:2] for r in rows])).collect()}
    for doc_id, text, gone in rows:
        assert cleaned[doc_id].span_dedup.n_removed == gone
        assert gone or cleaned[doc_id].text == text


def brute_sentences(rows, min_sentences=2, min_words=10):
    """Texts left when every sentence of a run that stands earlier, of any allowed length, goes."""
    firsts, out = set(), {}
    for doc_id, text in sorted(rows):
        parts = span_dedup.sentences(text)
        words = [part.split() for part in parts]
        gone, runs = set(), []
        for a in range(len(parts)):
            for b in range(a + min_sentences, len(parts) + 1):
                if sum(map(len, words[a:b])) >= min_words:
                    runs.append((a, b))
        for a, b in runs or [(0, len(parts))]:
            key = tuple(map(tuple, words[a:b]))
            if not runs:
                key = ("whole", *filter(None, key))
            if key in firsts:
                gone |= set(range(a, b))
            firsts.add(key)
        out[doc_id] = "".join(part for i, part in enumerate(parts) if i not in gone)
    return out


def test_sentences_of_repeated_runs_go(make_docs):
    rng = random.Random(4)
    pool = [sentence(rng, rng.choice([1, 2, 4, 8, 30])) for _ in range(60)]
    passages = [" ".join(rng.choices(pool, k=rng.randrange(2, 9))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.choice([1, 3, 9, 25])) for _ in range(rng.randrange(1, 7))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    rows += [(100 + i, passages[0]) for i in range(30)] + [(200, "Short."), (201, "Short.")]
    cleaned = span_dedup.remove_repeated_spans(make_docs(rows)).collect()
    assert {r.doc_id: r.text for r in cleaned} == brute_sentences(rows)


def test_frequent_keys_join_like_others(spark):
    rows = spark.createDataFrame([(i, i % 3 if i % 2 else 1000 + i // 4) for i in range(4001)], "a int, key int")
    counted = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").cache()
    for how in ("inner", "left"):
        found = common.join_counted(rows, counted, ["key"], how)
        plain = rows.join(counted, "key", how)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("sizes", [(15, 3, 2), (4, 4), (20,), (1, 1, 1, 30, 1)])
def test_spans_cover_the_text(sizes):
    rng = random.Random(3)
    parts = [sentence(rng, n) for n in sizes]
    covered = {i for a, n, _ in span_dedup.spans(parts, 2, 10) for i in range(a, a + n)}
    assert covered == set(range(len(parts)))
