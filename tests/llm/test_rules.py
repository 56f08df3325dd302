"""URL filters, mixing, decontamination, quality and WARC on small fixtures."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import random
import zipfile
from pathlib import Path

import numpy as np
import pytest

from cartwright.llm import (
    components,
    decontaminate,
    mixing,
    quality_gam,
    quality_rules,
    queries,
    text_measures,
    url_filter,
    warc,
)


@pytest.fixture
def make_pages(spark):
    schema = "page_id long, url string, html string, node string, own string, sha1 string"
    return lambda rows: spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60) if i % 13] + [(100, k) for k in range(101, 140)]
    edges += [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(20)]
    least = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame([*edges, (None, 5), (7, 7)], "a long, b long")
    found = dict(map(tuple, components.components(df, "a", "b").collect()))
    loops = {n for n in least if all(a == b for a, b in edges if n in (a, b))}
    assert found == {n: m for n, m in least.items() if n not in loops}


def test_verdicts_follow_aliases(make_pages):
    link = '<link href="{}" rel=canonical>'
    pages = [
        (1, "http://a.org/x", link.format("http://bad.net/")),
        (2, "http://b.org/y", '<meta http-equiv="refresh" content="0; url=http://a.org/x#top">'),
        (3, "http://c.org/z", link.format("http://bad.net/") + link.format("https://good.org/fr/1")),
        (4, "http://c.org/fr/z", link.format("http://bad.net/")),
        (5, None, None),
        (6, "no scheme", link.format("http://bad.net/")),
        (7, "HTTP://X.EXAMPLE.net/en/?q#f", ""),
        (7, "HTTP://X.EXAMPLE.net/en/?q#f", ""),
        (8, "http://d.org/p", link.format("/fr/1")),
        (9, "http://e.com?net/", ""),
    ]
    found = url_filter.filter_urls(make_pages(pages), queries.URL_RULES).collect()
    verdicts = {r.page_id: (r.rule, r.verdict) for r in found}
    assert len(found) == len(pages)
    # Pages 1 to 4 are one component with an allowed page; the rule of page 4 is its own.
    assert {k: verdicts[k] for k in (1, 2, 3)} == dict.fromkeys((1, 2, 3), (None, "allow"))
    assert verdicts[4] == ("org/fr/", "allow")
    assert verdicts[5] == verdicts[6] == verdicts[9] == (None, "allow")
    assert verdicts[7] == ("example.net/en/", "allow")
    assert verdicts[8] == (None, "allow")
    blocked = url_filter.filter_urls(make_pages(pages[:2]), queries.URL_RULES).collect()
    assert {r.verdict for r in blocked} == {"block"}
    assert url_filter.filter_urls(make_pages([]), queries.URL_RULES).count() == 0


def test_mix_reaches_targets(make_docs):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 90), None, rng.choice("abcd") if i % 5 else None) for i in range(900)]
    rows += [(1000, "w " * 5000, None, "e"), (1001, None, None, "f"), (1, "w w", None, "a"), (1, "w w", None, "a")]
    docs = make_docs(rows)
    fine = sorted(map(str, mixing.mix(docs, rows_per_chunk=3).collect()))
    found = mixing.mix(docs).collect()
    assert fine == sorted(map(str, found)) and len(found) == len(rows)
    total = sum(r.size for r in found)
    targets, sizes, taken = {}, {}, {}
    for r in found:
        assert r.copies <= 2 and r.taken == r.copies * r.size
        targets[r.source], sizes[r.source] = r.target, r.source_size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert math.isclose(sum(targets.values()), 1.5 * total)
    for source, target in targets.items():
        assert target <= 2 * sizes[source]
        largest = max(r.size for r in found if r.source == source)
        assert abs(taken[source] - target) <= 2 * largest
    assert mixing.mix(make_docs([])).count() == 0
    once = [(i, "w " * (i % 7), None, "a") for i in range(40)]
    mixed = mixing.mix(make_docs(once))
    assert mixing.emit(make_docs(once), mixed).count() == sum(r.copies for r in mixed.collect())


def test_contained_items_are_found(spark, make_docs):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(3000)]
    items = [(k, " ".join(rng.choices(words, k=k % 40 + 1))) for k in range(60)] + [(None, "p q r s t u")]
    items += [(100, None), (101, "..."), (5, items[5][1])]
    rows = []
    for i in range(80):
        text = rng.choices(words, k=rng.choice([10, 200, 3000]))
        at = rng.randrange(len(text))
        item = items[rng.randrange(61)][1].upper().replace(" ", ", ")
        rows.append((i, " ".join(text[:at]) + " " + item + "; " + " ".join(text[at:])))
    rows += [(k + 200, text) for k, text in items[:6]] + [(None, None), (None, "P Q R S T u"), (7, "")]

    def shingles(text):
        w = (text or "").lower().replace(",", " ").replace(";", " ").replace(".", " ").split()
        if not w:
            return set()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    expected = set()
    for doc_id, text in rows:
        for item_id, item in items:
            own = shingles(item)
            if own and len(own & shingles(text)) / len(own) >= 0.8:
                expected.add((doc_id, item_id))
    benchmark = spark.createDataFrame([(*i, "x", "y") for i in items], "item_id long, text string, class string, hash string")
    found = decontaminate.contaminated(make_docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected and len(found) == len(expected)
    left = decontaminate.decontaminate(make_docs(rows), benchmark).select("doc_id").collect()
    assert {r.doc_id for r in left} == {d for d, _ in rows} - {d for d, _ in expected}
    assert decontaminate.contaminated(make_docs([]), benchmark).count() == 0
    assert decontaminate.contaminated(make_docs(rows), benchmark.limit(0)).count() == 0


def test_base_measures():
    rng = random.Random(4)
    for _ in range(100):
        words = rng.choices("abc", k=rng.randrange(60))
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert text_measures.repeated_words(words) == len(covered)
    assert text_measures.base_measures("a b\n\na b\n \n#é|") == (5, 7, 2, 1, 0)
    assert text_measures.base_measures(None) == (0, 0, 0, 0, 0)


def test_gibberish_is_rejected(make_docs, odd):
    rng = random.Random(6)
    syllables = ["the", "an", "ti", "on", "er", "re"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(1, 4)))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60, 200))), "en") for i in range(200)]
    rows += [(500, "".join(rng.choices("bcdfghjk#$% ", k=900)), "en"), (501, "zq " * 12, "en")]
    rows += [(600 + (i or 0), text) for i, text in odd]
    found = {r.doc_id: r for r in quality_rules.rate(make_docs(rows)).collect()}
    assert not found[500].kept and not found[500].base_failed and found[501].base_failed
    assert sum(found[i].kept for i in range(200)) >= 198
    assert quality_rules.rate(make_docs([])).count() == 0


def test_classifier_learns(make_docs, spark, odd):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(400):
        good = i % 3 > 0
        words = ["word" + str(rng.randrange(99)) for _ in range(rng.randrange(20, 80))]
        rows.append((i, " ".join(words) + "." if good else " | ".join(words).upper()))
        marks.append((i, int(good), 0))
    marks += [(1, None, None), (None, 1, 0), (9999, 1, 0), (2, 7, 0), (3, 0, 0), (3, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    extra = [(900 + (i or 0), text) for i, text in odd]
    found = {r.doc_id: r for r in quality_gam.classify(make_docs(rows + extra), labels).collect()}
    tested = [i for i in range(400) if found[i].held_out]
    assert tested and sum(found[i].predicted == (i % 3 > 0) for i in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in found.values())
    none = quality_gam.classify(make_docs(rows[:3]), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 3
    assert quality_gam.classify(make_docs([]), labels).count() == 0


def test_training_rows_are_those_with_the_smallest_hashes(spark):
    rng = random.Random(5)
    columns = ["doc_id", "quality", *quality_gam.FEATURES]
    rows = [(k, float(k % 2), *(float(rng.randrange(9)) for _ in quality_gam.FEATURES), 1 + k % 3) for k in range(900)]
    rows += [(*rows[7][:-1], 1)] * 450
    schema = "doc_id long, quality double, " + ", ".join(f"{name} double" for name in quality_gam.FEATURES)
    labelled = spark.createDataFrame(rows, f"{schema}, n long")
    placed = labelled.selectExpr(f"xxhash64({', '.join(columns)}) AS place", "*").collect()
    ordered = [row[1:-1] for row in sorted(placed) for _ in range(row.n)]
    for sample in (40, 500, 5000):
        chosen = quality_gam._smallest_hashes(labelled, sample)
        assert list(chosen[columns].itertuples(index=False, name=None)) == ordered[:sample]
    assert not len(quality_gam._smallest_hashes(labelled.limit(0), 40))


def test_a_repeated_training_row_may_fill_the_sample(spark):
    row = (1, 1.0, *(2.0 for _ in quality_gam.FEATURES), 10**9)
    schema = "doc_id long, quality double, " + ", ".join(f"{name} double" for name in quality_gam.FEATURES)
    assert len(quality_gam._smallest_hashes(spark.createDataFrame([row], f"{schema}, n long"), 40)) == 40


def test_items_too_large_to_broadcast_are_found_alike(spark, make_docs, odd, monkeypatch):
    text = " ".join(f"w{k}" for k in range(30))
    documents = make_docs([*odd, (20, f"before {text} after"), (21, text), (22, text[: len(text) // 2])])
    items = spark.createDataFrame([(1, text), (2, text), (None, text), (3, None), (4, "")], "item_id long, text string")
    found = {}
    for most in (0, decontaminate.ITEM_BYTES):
        monkeypatch.setattr(decontaminate, "ITEM_BYTES", most)
        found[most] = sorted(decontaminate.contaminated(documents, items).collect(), key=str)
    assert found[0] == found[decontaminate.ITEM_BYTES]
    assert {(r.doc_id, r.item_id) for r in found[0]} == {(d, i) for d in (20, 21) for i in (1, 2, None)}


def test_archives_round_trip(spark, make_pages, tmp_path):
    pages = [(i, f"http://a/{i}", f"<p>{i % 7}é</p>\r\n\r\n" * (i % 5)) for i in range(60)]
    pages += [(None, None, None), (61, "http://a/\r\nX: y", None), (62, "u", "x" * 3_000_000), (63, "u", "\n"), (63, "u", "\n")]
    found = warc.round_trip(make_pages(pages).repartition(3), str(tmp_path / "a")).collect()
    for r in found:
        html = next(html for page_id, _, html in pages if page_id == r.page_id)
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        assert r.payload_digest == digest
    latest = {}
    for page_id, _, html in pages:
        latest[html or ""] = max(latest.get(html or "", -1), -1 if page_id is None else page_id)
    expected = []
    for page_id, _, html in pages:
        last = latest[html or ""]
        own = page_id == last
        size = len((html or "").encode())
        expected.append((page_id, size, "response" if own else "revisit", None if own else last))
    assert sorted(map(str, expected)) == sorted(
        str((r.page_id, r.payload_bytes, r.record_type, r.refers_to)) for r in found
    )
    files = [f for f in Path(tmp_path / "a").glob("part-*") if f.stat().st_size]
    records = 0
    for file in files:
        package = zipfile.ZipFile(file)
        assert package.testzip() is None
        archive, index = (package.read(name) for name in package.namelist())
        assert gzip.decompress(archive).count(b"WARC/1.1\r\n") == index.count(b"\n")
        records += index.count(b"\n")
    assert records == len(pages)
    assert warc.round_trip(make_pages([]), str(tmp_path / "b")).count() == 0


def test_tasks_follow_the_bytes_of_the_archives(spark, make_pages, tmp_path):
    pages = [(i, "u", f"{random.Random(i).random()}" * 20 if i % 3 else None) for i in range(300)]
    folder = str(tmp_path / "many")
    warc.write_archives(make_pages(pages), folder)
    size = sum(f.stat().st_size for f in Path(folder).glob("part-*"))
    read = warc.read_archives(spark, folder, block_bytes=4000)
    assert read.rdd.getNumPartitions() == -(-size // 4000) > 5
    assert sorted(r.page_id for r in read.collect()) == list(range(300))


def test_other_zip_files_are_read(tmp_path):
    path = tmp_path / "plain.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as package:
        package.writestr("a", b"hello")
        package.writestr("b", b"packed", compress_type=zipfile.ZIP_DEFLATED)
        package.comment = b"about PK\x05\x06 files"
    with warc.open_file(f"file:{path}") as file:
        members = warc.zip_members(file, path.stat().st_size)
        assert list(members) == ["a"]
        file.seek(members["a"][0])
        assert file.read(members["a"][1]) == b"hello"
