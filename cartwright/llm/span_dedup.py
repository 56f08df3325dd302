"""Removal of repeated passages, found as sliding runs of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import join_counted, same_keys, saved

#: What identifies a row: its id and a hash of its text. Rows equal in both count as one document.
KEY = ["doc_id", "text_hash"]

_SENTENCE = re.compile(r"[^\n]*?[.!?]+(?=[\s]|$)\s*|[^\n]+\n?\s*|\s+")


def sentences(text: str) -> list[str]:
    """Cut a text into sentences, which joined give the text again.

    A sentence ends with ``.``, ``!`` or ``?`` before whitespace, or with its line.
    """
    return _SENTENCE.findall(text)


def spans(parts: list[str], min_sentences: int, min_words: int) -> Iterator[tuple[int, int, bytes]]:
    """(start, length, digest) of the shortest runs that are long enough, from every start and to every end.

    Both edges of a repeated passage are edges of such runs. Whitespace around sentences doesn't matter.
    A text without a long enough run is one run.
    """
    counts = [0]
    bare = []
    for part in parts:
        words = part.split()
        counts.append(counts[-1] + len(words))
        bare.append(" ".join(words))
    runs = set()
    end = 0
    for start in range(len(parts)):
        end = max(end, start + min_sentences)
        while end <= len(parts) and counts[end] - counts[start] < min_words:
            end += 1
        if end > len(parts):
            break
        if bare[start]:
            runs.add((start, end - start))
    start = 0
    for end in range(min_sentences, len(parts) + 1):
        while start < end - min_sentences and counts[end] - counts[start + 1] >= min_words:
            start += 1
        if counts[end] - counts[start] >= min_words:
            runs.add((start, end - start))
    for start, length in sorted(runs):
        yield start, length, xxhash.xxh3_128_digest("\n".join(bare[start : start + length]))
    if not runs and counts[-1]:
        yield 0, len(parts), xxhash.xxh3_128_digest("\n".join(filter(None, bare)))


def _list_spans(min_sentences: int, min_words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Some documents at a time: a long text gives a row for every sentence.
            rows = []
            for doc_id, text_hash, text in batch.itertuples(index=False, name=None):
                met = set()
                for start, length, digest in spans(sentences(text or ""), min_sentences, min_words):
                    high = int.from_bytes(digest[:8], "little", signed=True)
                    low = int.from_bytes(digest[8:12], "little", signed=True)
                    rows.append((high, low, doc_id, text_hash, start, length, digest in met))
                    met.add(digest)
                if len(rows) >= 50_000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["high", "low", "doc_id", "text_hash", "start", "length", "again"]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def _without(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    rows = []
    for text, at, long in zip(texts, starts, lengths):
        parts = sentences(text or "")
        if at is None:
            rows.append((text, len(parts), 0, 0))
            continue
        edges = np.zeros(len(parts) + 1, dtype=np.int64)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + long, -1)
        covered = np.cumsum(edges[:-1]) > 0
        runs = int(covered[0]) + int(np.sum(covered[1:] & ~covered[:-1]))
        kept = "".join(part for part, gone in zip(parts, covered) if not gone)
        rows.append((kept, len(parts), int(covered.sum()), runs))
    return pd.DataFrame(rows, columns=["text", "n_sentences", "n_removed", "n_spans"])


def remove_repeated_spans(
    documents: DataFrame, min_sentences: int = 2, min_words: int = 10
) -> DataFrame:
    """Remove every sentence covered by a span of sentences that stands earlier in the collection.

    From every sentence on, and up to every sentence, the shortest run of at least ``min_sentences``
    sentences and ``min_words`` words is a span; these cover what all runs of so many sentences and words
    would. A text too short for one is a span as a whole. Of equal spans the first one of the document with
    the smallest doc_id (NULL last) stays; the sentences of all others go, also within one document. Spans
    are equal if their sentences are, up to whitespace, by a 96-bit hash.

    A text that is NULL or blank stays as it is; one of any length is cut whole. Rows that share an id don't
    take spans from one another; rows equal in id and text count as one document, by a 64-bit hash of the text.
    Returns all columns of ``documents`` with ``text`` replaced, and one struct ``span_dedup`` (n_sentences,
    n_removed, n_spans: maximal removed runs); other columns may have any names but that. An empty table stays
    empty.

    Texts are cut once and their spans saved, as hashes. Spans are counted with partial sums before they
    shuffle. The join that finds the repeats broadcasts the most frequent spans, so none of them lands in one
    task. A document's repeats, no more than its sentences, come together in one row, which its text meets
    in one shuffle.
    """
    text_hash = F.xxhash64("text")
    keyed = documents.select("doc_id", text_hash.alias("text_hash"), "text")
    found = saved(
        keyed.mapInPandas(
            _list_spans(min_sentences, min_words),
            "high long, low int, doc_id long, text_hash long, start int, length int, again boolean",
        ),
        "all-spans",
    )
    repeated = (
        found.groupBy("high", "low")
        .agg(F.min("doc_id").alias("earliest"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    repeated = saved(repeated, "repeated-spans")
    later = join_counted(found, repeated, ["high", "low"]).filter("again OR NOT doc_id <=> earliest")
    repeats = saved(
        later.groupBy(*KEY).agg(F.collect_set(F.struct("start", "length")).alias("spans")), "spans"
    )
    rows = documents.select(F.struct("*").alias("row"), "doc_id", text_hash.alias("text_hash"))
    matched = rows.join(repeats, same_keys(rows, repeats, KEY), "left")
    without = F.pandas_udf(
        _without, "text string, n_sentences long, n_removed long, n_spans long"
    )
    cut = without(F.col("row.text"), F.col("spans.start"), F.col("spans.length"))
    done = matched.select("row", cut.alias("cut"))
    kept = [
        F.col("cut.text") if name == "text" else F.col(f"row.`{name}`") for name in documents.columns
    ]
    counts = F.struct(F.col("cut.n_sentences"), F.col("cut.n_removed"), F.col("cut.n_spans"))
    return done.select(*kept, counts.alias("span_dedup"))
