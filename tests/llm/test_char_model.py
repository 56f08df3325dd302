"""The language model of the quality rules against a plain estimate, at every size and language."""

from __future__ import annotations

import inspect
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cartwright.llm import char_model, quality_rules, text_measures

LATIN, GREEK = "abcdefghij", "αβγδεζηθικ"


def prose(rng, letters, n=120):
    parts = ["".join(rng.choices(letters, k=rng.randrange(1, 3))) for _ in range(12)]
    return " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(n))


def plain_estimate(counts):
    """log2 probabilities of the grams of one language, from their counts."""
    levels = [Counter(counts)]
    while len(next(iter(levels[0]))) > 1:
        levels.insert(0, Counter(gram[1:] for gram in levels[0]))
    lower, p = {"": 1 / len(levels[0])}, {}
    for level in levels:
        n = [sum(v == k for v in level.values()) for k in (1, 2, 3, 4)]
        discounts = [0, 0.5, 0.5, 0.5]
        if min(n):
            y = n[0] / (n[0] + 2 * n[1])
            discounts = [0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]
        total, left = Counter(), defaultdict(float)
        for gram, v in level.items():
            total[gram[:-1]] += v
            left[gram[:-1]] += discounts[min(v, 3)]
        p = {
            gram: (v - discounts[min(v, 3)]) / total[gram[:-1]]
            + left[gram[:-1]] / total[gram[:-1]] * lower[gram[1:]]
            for gram, v in level.items()
        }
        lower = p
    return {gram: math.log2(value) for gram, value in p.items()}


def test_model_equals_a_plain_estimate(make_docs, monkeypatch):
    rng = random.Random(1)
    texts = {None: [prose(rng, "漢字仮名交文 ab") for _ in range(9)], "fr": [prose(rng, LATIN) for _ in range(30)]}
    texts["fr"] += ["", "é", "😀\0x", None]
    rows = [(i, t, lang) for lang in texts for i, t in enumerate(texts[lang])]
    for letters in (char_model.LETTERS, 12):
        # With few numbers for characters a task starts again, or counts one run at a time.
        monkeypatch.setattr(char_model, "LETTERS", letters)
        counted = char_model.saved(char_model.count_grams(make_docs(rows)), "test")
        monkeypatch.undo()
        found = defaultdict(dict)
        for r in char_model.estimate(counted).collect():
            found[r.language][r.gram] = r.log2
        assert set(found) == {"", "=fr"}
        for lang, key in ((None, ""), ("fr", "=fr")):
            grams = Counter(g for t in texts[lang] if t for g in char_model.text_grams(t))
            expected = plain_estimate(grams)
            assert found[key].keys() == expected.keys()
            assert all(math.isclose(found[key][g], expected[g], abs_tol=1e-9) for g in expected)


def log2_after(model, run):
    """log2 of the probability of a run's last character, from the rows of a model by (kind, gram)."""
    weight = 0.0
    for k in range(char_model.ORDER, 0, -1):
        if (k, run[-k:]) in model:
            return weight + model[k, run[-k:]]
        weight += model.get((1 - k, run[-k:-1]), 0.0) if k > 1 else model[0, ""]
    return weight


def test_probabilities_add_up(make_docs):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices("abcd e.", k=300)), "fr") for i in range(4)]
    counted = char_model.saved(char_model.count_grams(make_docs(rows)), "test")
    model = {(r.kind, r.gram): r.log2 for r in char_model.backoff_model(counted).collect()}
    letters = {gram for kind, gram in model if kind == 1}
    contexts = {gram[:-1] for kind, gram in model if kind == char_model.ORDER} | {"zzz", "zab", "zza"}
    assert len(contexts) > 100
    for context in contexts:
        assert math.isclose(sum(2 ** log2_after(model, context + c) for c in letters), 1, abs_tol=1e-9)


def plain_rating(rows, halves):
    """(bits, kept) of every row: by the model of the texts in the other half, and exact medians."""
    counts = defaultdict(Counter)
    for (_, text, lang), half in zip(rows, halves):
        counts[lang, half].update(char_model.text_grams(text or ""))
    models = {}
    for key, grams in counts.items():
        levels = [Counter(grams)]
        while len(next(iter(levels[0]), "")) > 1:
            levels.insert(0, Counter(gram[1:] for gram in levels[0]))
        if not grams:
            continue
        model, lower = {}, {"": 1 / len(levels[0])}
        for k, level in enumerate(levels, 1):
            n = [sum(v == c for v in level.values()) for c in (1, 2, 3, 4)]
            d = [0, 0.5, 0.5, 0.5]
            if min(n):
                y = n[0] / (n[0] + 2 * n[1])
                d = [0] + [min(max(c - (c + 1) * y * n[c] / n[c - 1], 0.05), c - 0.05) for c in (1, 2, 3)]
            total, left = Counter(), defaultdict(float)
            for gram, v in level.items():
                total[gram[:-1]] += v
                left[gram[:-1]] += d[min(v, 3)]
            weight = {c: left[c] / total[c] for c in total}
            lower = {
                g: (v - d[min(v, 3)]) / total[g[:-1]] + weight[g[:-1]] * lower[g[1:]] for g, v in level.items()
            }
            model |= {(k, g): math.log2(p) for g, p in lower.items()}
            model |= {(1 - k, c): math.log2(w / (len(levels[0]) if k == 1 else 1)) for c, w in weight.items()}
        models[key] = model
    bits = []
    for (_, text, lang), half in zip(rows, halves):
        model = models.get((lang, 1 - half))
        if not text:
            bits.append(None)
        elif model is None:
            bits.append(0.0)
        else:
            each = [-log2_after(model, gram) for gram in char_model.text_grams(text)]
            n = max(1, len(each) // 64)
            edges = [i * len(each) // n for i in range(n + 1)]
            bits.append(float(np.median([np.mean(each[i:j]) for i, j in zip(edges, edges[1:])])))
    kept = []
    middle = lambda values: sorted(values)[math.ceil(len(values) / 2) - 1]
    failed = [text_measures.base_measures(t)[0] < 20 or 100 * text_measures.base_measures(t)[4] > 30 * text_measures.base_measures(t)[0] for _, t, _ in rows]
    for (_, text, lang), own, bad in zip(rows, bits, failed):
        if bad:
            kept.append(False)
            continue
        fit = [b for b, f, (_, _, other) in zip(bits, failed, rows) if other == lang and not f]
        spread = max(middle([abs(b - middle(fit)) for b in fit]), 0.02)
        kept.append(abs(own - middle(fit)) <= 6 * spread * math.sqrt(1 + 400 / len(text)))
    return bits, kept


@pytest.mark.parametrize("block,held", [(1 << 20, 256 << 20), (50, 0)])
def test_rating_equals_a_plain_version(spark, make_docs, monkeypatch, odd, block, held):
    """Also where a model has many blocks and a task holds one at a time."""
    rng = random.Random(2)
    rows = [(i, prose(rng, LATIN if i % 2 else GREEK), "fr" if i % 2 else "el") for i in range(60)]
    rows += [(70, "xq zv " * 40, "fr"), (71, "xq zv " * 40, "fr"), (72, rows[3][1], None), (73, prose(rng, LATIN), "el")]
    rows += [(74, " ".join("".join(rng.choices("qwxzkvnmQ9", k=5)) for _ in range(60)), "fr"), (75, rows[5][1], "fr")]
    rows += [(80 + n, text, None) for n, (_, text) in enumerate(odd)]
    monkeypatch.setattr(char_model, "BLOCK", block)
    monkeypatch.setattr(char_model, "HELD", held)
    found = {r.doc_id: r for r in quality_rules.rate(make_docs(rows)).collect()}
    halves = make_docs(rows).selectExpr("doc_id", "pmod(xxhash64(text), 2) AS half").collect()
    half = {r.doc_id: r.half for r in halves}
    bits, kept = plain_rating(rows, [half[row[0]] for row in rows])
    assert len(found) == len(rows)
    for (doc_id, *_), expected, stays in zip(rows, bits, kept):
        assert (found[doc_id].bits is None) == (expected is None), doc_id
        assert np.isclose(found[doc_id].bits or 0, expected or 0), doc_id
        assert found[doc_id].kept == stays, doc_id
    assert not found[73].kept and not found[74].kept and found[5].kept


@pytest.mark.parametrize("one,other", [("fr", "el"), ("pl", None), ("ru", "tr"), (None, "")])
def test_languages_are_told_apart(make_docs, one, other):
    rng = random.Random(3)
    large = [(i, prose(rng, LATIN), one) for i in range(90)]
    few = [(200 + i, prose(rng, GREEK), other) for i in range(9)]
    alone = {r.doc_id: r.bits for r in quality_rules.rate(make_docs(few)).collect()}
    both = {r.doc_id: r for r in quality_rules.rate(make_docs(large + few)).collect()}
    assert all(np.isclose(both[i].bits, alone[i]) and both[i].kept for i in alone)


def test_characters_are_told_apart(make_docs):
    rng = random.Random(4)
    parts = ["".join(rng.choices(GREEK, k=2)) for _ in range(8)]
    text = lambda: " ".join(rng.choice(parts) + rng.choice(parts) for _ in range(150))
    rows = [(i, text(), "el") for i in range(150)]
    # Every letter stays the same modulo 5, and each has four shapes.
    other = "".join(c if c == " " else chr(ord(c) + 5 * rng.randrange(4, 8)) for c in text())
    found = {r.doc_id: r for r in quality_rules.rate(make_docs([*rows, (500, other, "el")])).collect()}
    assert not found[500].kept and not found[500].base_failed
    assert sum(found[i].kept for i in range(150)) >= 148


def test_both_limits_are_the_same():
    limits = inspect.signature(quality_rules.rate).parameters
    assert limits["above"].default == limits["below"].default
