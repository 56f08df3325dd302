"""Line, span and suffix dedup and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from cartwright.llm import jaccard_join, line_dedup, span_dedup, suffix_dedup

WORDS = [f"w{i}" for i in range(400)]


def sentence(rng, n=9):
    return " ".join(rng.choices(WORDS, k=n)) + "."


def brute_strings(rows, length):
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            part = data[k : k + length]
            if part in seen:
                gone[k : k + length] = True
            seen.add(part)
        spans = int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1, 20_000])
def test_repeated_strings(make_docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(1)
    passage = " ".join(sentence(rng) for _ in range(5))
    rows = []
    for i in range(40):
        parts = [sentence(rng) for _ in range(6)]
        if i % 3 == 0:
            cut = rng.randrange(60)
            parts.insert(rng.randrange(6), passage[cut : cut + rng.randrange(90, 200)])
        rows.append((i, " ".join(parts)))
    rows += [(50, rows[4][1]), (51, "ab" * 300), (52, "x" * 99), (53, "é" * 200), (54, "")]
    found = suffix_dedup.remove_repeated_strings(make_docs(rows)).drop("kept").collect()
    assert sorted(map(tuple, found)) == brute_strings(rows, 100)


def test_odd_documents_keep_their_rows(make_docs, odd):
    docs = make_docs(odd)
    strings = suffix_dedup.remove_repeated_strings(docs).collect()
    assert len(strings) == len(odd)
    # A text of one repeated pattern covers itself from its second period on.
    assert {r.n_removed for r in strings if r.doc_id == 4} == {42000 - 14}
    for cleaned in (line_dedup.remove_repeated_lines(docs), span_dedup.remove_repeated_spans(docs)):
        assert cleaned.columns[:-1] == docs.columns
        texts = sorted((r.doc_id or 0, r.text or "") for r in cleaned.collect() if r.doc_id != 4)
        assert [t for t in texts if t[0] != 6] == sorted((i or 0, t or "") for i, t in odd if i not in (4, 6))
    linked = jaccard_join.link_documents(docs).collect()
    assert sorted(map(str, linked)) == sorted(
        f"Row(doc_id={i}, n_shingles={n}, component_id={i})"
        for i, n in [(None, 0), (None, 0), (1, 0), (2, 0), (3, 1), (3, 1), (4, 7), (5, 0), (6, 5)]
    )


def test_empty_tables(make_docs):
    docs = make_docs([])
    assert suffix_dedup.remove_repeated_strings(docs).count() == 0
    assert line_dedup.remove_repeated_lines(docs).count() == 0
    assert span_dedup.remove_repeated_spans(docs).count() == 0
    assert jaccard_join.link_documents(docs).count() == 0


def test_repeated_runs_of_lines_go_and_others_stay(make_docs):
    rng = random.Random(2)
    shared = [sentence(rng) for _ in range(14)]
    rows = []
    for i in range(30):
        own = [sentence(rng) for _ in range(6)]
        at = rng.randrange(7)
        rows.append((i, "\n".join(own[:at] + (shared if i % 2 else [shared[0]]) + own[at:])))
    cleaned = {r.doc_id: r for r in line_dedup.remove_repeated_lines(make_docs(rows)).collect()}
    for i, text in rows:
        lines, kept = text.split("\n"), cleaned[i].text.split("\n")
        assert set(lines) - set(kept) <= set(shared)
        if i % 2 == 0 or i == 1:
            assert kept == lines
        else:
            assert cleaned[i].line_dedup.n_removed >= 6
            assert len(lines) - len(kept) == cleaned[i].line_dedup.n_removed


def test_chunks_of_equal_lines_are_equal():
    rng = random.Random(3)
    shared = [sentence(rng) for _ in range(60)]
    cuts = []
    for extra in range(3):
        lines = [sentence(rng) for _ in range(extra + 2)] + shared
        bounds = line_dedup.chunk_bounds(lines, 3)
        assert [a for a, _ in bounds[1:]] == [b for _, b in bounds[:-1]]
        assert all(b - a >= 2 for a, b in bounds)
        cuts.append({a - extra - 2 for a, _ in bounds if a > extra + 20})
    assert len(cuts[0] & cuts[1] & cuts[2]) >= 5


def test_repeated_passages_go_and_others_stay(make_docs):
    rng = random.Random(4)
    passages = [" ".join(sentence(rng, rng.randrange(2, 20)) for _ in range(8)) for _ in range(3)]
    rows = []
    for i in range(30):
        own = [sentence(rng, rng.randrange(3, 25)) for _ in range(6)]
        if i % 3 == 0:
            own.insert(rng.randrange(7), passages[i // 3 % 3])
        rows.append((i, " ".join(own)))
    cleaned = {r.doc_id: r for r in span_dedup.remove_repeated_spans(make_docs(rows)).collect()}
    for i, text in rows:
        if i % 3 or i < 9:
            assert cleaned[i].text == text and cleaned[i].span_dedup.n_removed == 0
        else:
            assert len(text) - len(cleaned[i].text) > 0.6 * len(passages[i // 3 % 3])


def test_sentences_join_to_the_text():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices("ab .!?\n\t,é", k=rng.randrange(120)))
        assert "".join(span_dedup.sentences(text)) == text


def brute_components(rows, shingle, percent):
    sets = {}
    for doc_id, text in rows:
        words = text.lower().split()
        sets[doc_id] = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common) and least[b] < least[a]:
                    least[a], changed = least[b], True
    return sorted((i, len(sets[i]), least[i]) for i in sets)


@pytest.mark.parametrize("block", [300, 2_000_000])
def test_components_of_links(make_docs, block):
    rng = random.Random(6)
    rows = []
    for group in range(6):
        size = rng.choice([8, 20, 60, 150])
        words = rng.choices(WORDS, k=size)
        for _ in range(12):
            # A chain: each version differs a little from the one before.
            words = list(words)
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            if rng.random() < 0.3:
                words.append(rng.choice(WORDS))
            rows.append((1000 - len(rows), " ".join(words)))
    found = jaccard_join.link_documents(make_docs(rows), block_shingles=block).collect()
    assert sorted(map(tuple, found)) == brute_components(rows, 3, 90)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(7)
    for _ in range(400):
        size = int(rng.integers(3, 400))
        a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
        keep = max(1, int(np.ceil(len(a) * percent / 100)))
        b = a[np.sort(rng.permutation(len(a))[:keep])]
        if len(b) < len(a):
            assert np.intersect1d(jaccard_join.part_keys(a, percent), jaccard_join.part_keys(b, percent)).size


def test_repeated_lines_are_the_same_with_and_without_broadcast(make_docs, monkeypatch):
    shared = "".join(f"shared line {k}\n" for k in range(12))
    rows = [(1, shared + "own a\nown b"), (2, shared + "own c\nown d"), (2, shared + "own c\nown d"), (3, "alone")]
    found = []
    for limit in (0, 400_000):
        monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", limit)
        cleaned = line_dedup.remove_repeated_lines(make_docs(rows)).select("doc_id", "text").collect()
        found.append(sorted(map(tuple, cleaned)))
    assert found[0] == found[1] and len(found[0]) == 4
    assert found[0][0] == rows[0] and found[0][1] == found[0][2]
    assert found[0][1][1].endswith("own c\nown d") and len(found[0][1][1]) < len(shared)
