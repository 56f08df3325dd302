"""Fill-in-middle: exact round trips and a plain version."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartwright.llm import fill_middle
from cartwright.llm.fill_middle import FillMiddle, fill_in_middle, restored


def plain_version(doc_id, text, how):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    digest = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    p, s, m = (mark.decode() for mark in (how.prefix, how.suffix, how.middle))
    if not text or p in text or s in text or m in text or h3 % 100 >= how.rate:
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (lines[:one], lines[one:two], lines[two:]))
    spm = h4 % 100 < how.spm_rate
    output = f"{s}{suffix}{p}{prefix}{m}{middle}" if spm else f"{p}{prefix}{s}{suffix}{m}{middle}"
    return n, "spm" if spm else "psm", len(prefix), len(middle), output


def transformed(df):
    fields = ("n", "form", "prefix_chars", "middle_chars", "output")
    return df.select("doc_id", "text", *(f"fill_middle.{name}" for name in fields)).collect()


@pytest.mark.parametrize("how", [FillMiddle(), FillMiddle(11, 60, 20, b"[pre]", b"{suf]", b"\x01mid")])
def test_equals_plain_version(spark, make_docs, odd, how):
    rows = [*odd, *((i, "\n".join(f"line {k} of {i} é" for k in range(i % 9)) + "\n" * (i % 3)) for i in range(100, 180))]
    rows += [(200, "a <P> b\nc"), (201, "x\n<S>"), (202, "<M>"), (203, "<"), (204, "ends with <P\n<S\n<M"), (205, "a\r\nb\x85c d")]
    made = fill_in_middle(make_docs(rows), how)
    expected = sorted((i, t, *plain_version(i, t, how)) for i, t in rows if i is not None)
    assert sorted(tuple(r) for r in transformed(made) if r.doc_id is not None) == expected
    unnamed = [tuple(r) for r in transformed(made) if r.doc_id is None]
    assert sorted(unnamed, key=str) == sorted(((i, t, *plain_version(i, t, how)) for i, t in rows if i is None), key=str)
    back = made.withColumn("back", restored(F.col("fill_middle.output"), F.col("fill_middle.form"), how))
    assert back.filter("back <> coalesce(text, '')").count() == 0


def test_both_forms_occur(spark, make_docs):
    made = fill_in_middle(make_docs([(i, "a\nb\nc\n") for i in range(200)]))
    forms = dict(made.groupBy("fill_middle.form").count().collect())
    assert set(forms) == {"psm", "spm"} and min(forms.values()) > 60


def test_columns_stay(spark, make_docs, odd):
    docs = make_docs(odd).withColumn("fill_middle", F.lit("old")).withColumn("made", F.lit(1))
    made = fill_in_middle(docs)
    assert [c for c in made.columns if c != "fill_middle"] == [c for c in docs.columns if c != "fill_middle"]
    assert fill_in_middle(make_docs([])).count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


@settings(deadline=None, max_examples=300)
@given(st.text("ab\n<>PSMé😀"), st.integers(0, 10**6), st.integers(0, 100))
def test_round_trip(text, doc_id, spm_rate):
    how = FillMiddle(spm_rate=spm_rate)
    n, form, prefix, middle, output = fill_middle.transform(text.encode(), doc_id, how)
    assert (n, form, prefix, middle, output.decode()) == plain_version(doc_id, text, how)
    assert fill_middle.restore(output, form, how).decode() == text


@given(st.binary(), st.data())
def test_rotation(data, draw):
    start = draw.draw(st.integers(0, len(data)))
    cut = draw.draw(st.integers(start, len(data)))
    end = draw.draw(st.integers(cut, len(data)))
    buffer = bytearray(data)
    fill_middle.rotate(buffer, start, cut, end)
    assert bytes(buffer) == data[:start] + data[cut:end] + data[start:cut] + data[end:]
    fill_middle.rotate(buffer, start, start + end - cut, end)
    assert bytes(buffer) == data


@pytest.mark.parametrize("marks", [(b"<P>", b"<P>", b"<M>"), (b"", b"<S>", b"<M>"), (b"<<", b"<S>", b"<M>"), (b"<P>", b"S>", b"<S")])
def test_sentinels_that_could_be_misread(marks):
    with pytest.raises(ValueError):
        FillMiddle(prefix=marks[0], suffix=marks[1], middle=marks[2])
