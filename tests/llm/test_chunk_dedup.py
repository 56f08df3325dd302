"""Exact dedup by recipes against plain comparison of texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cartwright.llm import chunk_dedup
from cartwright.llm.chunk_dedup import find_copies, remove_copies


# A hash of three values, which nearly every chunk shares with others; unnamed, so that tasks get it by value.
narrow = lambda data: bytes([sum(data) % 3])


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        for place, doc_id in enumerate(sorted(ids, key=lambda i: (i is not None, i), reverse=True)):
            out[(doc_id, keep, len(ids), place == 0, digest)] += 1
    return out


def found(df):
    return Counter(tuple(row) for row in df.collect())


def texts(seed):
    """Texts that share long pieces in other orders and differ in a single byte, and copies of them."""
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abcdefg \n") for _ in range(rng.randrange(100, 4000))) for _ in range(6)]
    made = []
    for _ in range(30):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 8)))
        made.append(text)
        at = rng.randrange(len(text))
        made.append(text[:at] + "#" + text[at + 1 :])
        made += [text] * rng.randrange(3)
    rng.shuffle(made)
    return list(enumerate(made))


@pytest.mark.parametrize("chunk_hash", [chunk_dedup._hash, narrow])
def test_equals_plain_comparison(spark, make_docs, chunk_hash):
    """Also where hashes of chunks collide."""
    rows = texts(1)
    assert found(find_copies(make_docs(rows), chunk_hash)) == brute(rows)


@pytest.mark.parametrize("chunk_hash", [chunk_dedup._hash, narrow])
def test_odd_rows(spark, make_docs, odd, chunk_hash):
    rows = [*odd, (9, "x" * 100_000), (8, "x" * 100_000), (9, "x" * 100_001), (7, "a\0b"), (6, "a\0b")]
    assert found(find_copies(make_docs(rows), chunk_hash)) == brute(rows)


def test_common_text(spark, make_docs, monkeypatch):
    """A text that a third of the rows have, joined by broadcast or without."""
    rows = [(i, "the same long text " * 50 if i % 3 == 0 else f"text {i % 100}") for i in range(900)]
    assert found(find_copies(make_docs(rows))) == brute(rows)
    monkeypatch.setattr(chunk_dedup, "BROADCAST_BYTES", 0)
    assert found(find_copies(make_docs(rows))) == brute(rows)


def test_no_rows(spark, make_docs):
    assert find_copies(make_docs([])).count() == 0
    assert remove_copies(make_docs([])).count() == 0


def test_remove_copies(spark, make_docs, odd):
    rows = [*odd, *texts(2)]
    docs = make_docs(rows)
    kept = remove_copies(docs)
    assert kept.columns == docs.columns
    expected = Counter((row[0], row[4]) for row in brute(rows).elements() if row[3])
    digests = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept.collect())
    assert digests == expected


def chunks_of(text: bytes, before: bytes = b""):
    array = pa.array([before, text], pa.binary())
    return [bytes(chunk) for chunk in list(chunk_dedup._texts(array))[1]]


def test_chunks_resist_shifts():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 300_000, np.uint8).tobytes()
    chunks = chunks_of(text)
    assert b"".join(chunks) == text
    assert all(len(c) <= chunk_dedup.MOST for c in chunks) and all(len(c) >= chunk_dedup.LEAST for c in chunks[:-1])
    # What stands before a text in its batch doesn't matter.
    assert chunks_of(text, before=text[:777]) == chunks
    shifted = chunks_of(b"some bytes more" + text)
    assert len(set(chunks) & set(shifted)) > 0.95 * len(chunks)


def test_block_edges_do_not_matter(monkeypatch):
    data = np.random.default_rng(5).integers(0, 256, 50_000, np.uint8)
    whole = chunk_dedup.cut_candidates(data).tolist()
    monkeypatch.setattr(chunk_dedup, "_BLOCK", 999)
    assert chunk_dedup.cut_candidates(data).tolist() == whole


def test_texts_are_shuffled_once(spark, make_docs):
    """Text passes one exchange, as distinct chunks; recipes are all that is saved."""
    docs = make_docs(texts(3))
    recipes = chunk_dedup.verified_recipes(docs)
    assert set(recipes.columns) == {"mark", "doc_id", "text_sha256", "recipe"}
    assert "Exchange" not in recipes._jdf.queryExecution().executedPlan().toString()
