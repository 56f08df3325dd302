"""Removal of repeated runs of lines, found by every two consecutive lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import BROADCAST_ROWS, join_counted, only, same_keys, saved

#: What identifies a row: its id and a hash of its text. Rows equal in both count as one document.
KEY = ["doc_id", "text_hash"]
#: Where the first of equal runs stands.
FIRST = ["first_id", "first_hash", "first_line"]
CUT = (
    "doc_id long, text_hash long, line int, size int, first_id long, first_hash long, first_line int, "
    "is_first boolean, bytes binary"
)


def chunk_bounds(lines: list[str], divisor: int) -> list[tuple[int, int]]:
    """Cut lines into chunks where a rolling hash over the hashes of two lines says so.

    A cut depends on the two lines before it alone, so the same lines are cut alike wherever they
    stand. A chunk shorter than two lines joins the one after it, the last one the one before it.
    """
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(line) for line in lines), dtype=np.uint64, count=len(lines)
    )
    rolled = hashes[1:] + hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    rolled ^= rolled >> np.uint64(29)
    cuts = np.flatnonzero(rolled % np.uint64(divisor) == 0) + 2
    bounds, start = [], 0
    for cut in cuts.tolist():
        if cut - start >= 2:
            bounds.append((start, cut))
            start = cut
    if len(lines) - start >= 2 or not bounds:
        bounds.append((start, len(lines)))
    else:
        bounds[-1] = (bounds[-1][0], len(lines))
    return bounds


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def pairs(lines: list[str]) -> Iterator[tuple[int, bytes]]:
    """(line, digest) of every two consecutive lines that aren't both blank.

    What follows the last line end isn't a line if it's empty.
    """
    size = len(lines) - (not lines[-1])
    for at in range(size - 1):
        if lines[at].strip() or lines[at + 1].strip():
            yield at, xxhash.xxh3_128_digest(f"{lines[at]}\n{lines[at + 1]}")


def _list_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [
            (doc_id, text_hash, at, digest)
            for doc_id, text_hash, text in batch.itertuples(index=False)
            for at, digest in pairs(_lines(text))
        ]
        yield pd.DataFrame(rows, columns=["doc_id", "text_hash", "line", "digest"]).astype({"doc_id": "Int64"})


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the listed runs."""
    for batch in batches:
        rows = []
        for doc_id, text_hash, text, *wanted in batch.itertuples(index=False):
            lines = _lines(text)
            rows += [
                (doc_id, text_hash, *run, "\n".join(lines[run[0] : run[0] + run[1]]).encode())
                for run in zip(*wanted)
            ]
        names = [field.split()[0] for field in CUT.split(", ")]
        yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64", "first_id": "Int64"})


def _without(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.DataFrame:
    """The text without the runs of lines that start at the given lines, and counts of lines."""
    rows = []
    for text, at, long in zip(texts, starts, sizes):
        if at is None:
            rows.append((text, 0 if text is None else text.count("\n") + 1, 0))
            continue
        lines = _lines(text)
        gone = {i for a, n in zip(at, long) for i in range(a, a + n)}
        kept = [line for i, line in enumerate(lines) if i not in gone]
        rows.append(("\n".join(kept), len(lines), len(gone)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])


def _broadcast_if_short(df: DataFrame, lists: str) -> DataFrame:
    """Mark a saved frame for broadcast if its lists were counted to have few entries in all."""
    entries = df.agg(F.sum(F.size(lists))).first()[0] or 0
    return F.broadcast(df) if entries <= BROADCAST_ROWS else df


def repeated_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, runs): the runs of lines of a document that stand earlier, as line and size.

    The first of equal pairs of lines is that of the smallest (doc_id, text hash, line). Pairs are
    found by a 128-bit hash. Consecutive ones whose firsts are consecutive, too, are one run, whose
    bytes are then compared with those of the first.
    """
    listed = saved(
        documents.mapInPandas(_list_pairs, "doc_id long, text_hash long, line int, digest binary"), "pairs"
    )
    firsts = (
        listed.groupBy("digest")
        .agg(F.min(F.struct(*KEY, "line")).alias("earliest"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    firsts = saved(firsts, "firsts")
    ahead = F.col("line") - F.col("earliest.line")
    own = F.col("doc_id").eqNullSafe(F.col("earliest.doc_id")) & (
        F.col("text_hash") == F.col("earliest.text_hash")
    )
    # A pair that shares a line with its first, or is the first, doesn't stand earlier.
    found = (
        join_counted(listed, firsts, ["digest"])
        .filter(~own | (ahead > 1))
        .select(
            *KEY,
            "line",
            ahead.alias("ahead"),
            F.col("earliest.doc_id").alias("first_id"),
            F.col("earliest.text_hash").alias("first_hash"),
        )
        # Repeated rows give the same.
        .distinct()
    )
    same = ["doc_id", "text_hash", "first_id", "first_hash", "ahead"]
    place = F.row_number().over(Window.partitionBy(*same).orderBy("line"))
    runs = saved(
        found.withColumn("gap", F.col("line") - place)
        .groupBy(*same, "gap")
        .agg(F.min("line").alias("line"), (F.count("*") + 1).cast("int").alias("size")),
        "runs",
    )
    begun = (F.col("line") - F.col("ahead")).alias("first_line")
    later = runs.select(*KEY, "line", "size", *FIRST[:2], begun, F.lit(False).alias("is_first"))
    # A first run is cut out once, however often it stands again.
    first = later.select(
        F.col("first_id").alias("doc_id"),
        F.col("first_hash").alias("text_hash"),
        F.col("first_line").alias("line"),
        "size",
        *FIRST,
        F.lit(True).alias("is_first"),
    ).distinct()
    # A document with repeated runs once, with all of them: no more than it has lines.
    listed_runs = F.collect_set(F.struct("line", "size", *FIRST, "is_first")).alias("wanted")
    wanted = saved(later.unionAll(first).groupBy(*KEY).agg(listed_runs), "wanted")
    named = only(documents, wanted, KEY)
    wanted = _broadcast_if_short(wanted, "wanted")
    fields = [f"wanted.{name}" for name in ("line", "size", *FIRST, "is_first")]
    asked = named.join(wanted, same_keys(named, wanted, KEY)).select(
        named.doc_id, named.text_hash, "text", *fields
    )
    cut = saved(asked.mapInPandas(_cut_out, CUT), "cut")
    # Repeated rows give a first run several times.
    original = cut.filter("is_first").groupBy(*FIRST, "size").agg(F.min("bytes").alias("original"))
    again = cut.filter("NOT is_first")
    met = again.join(original, same_keys(again, original, [*FIRST, "size"]))
    repeats = met.filter("bytes = original").select(*KEY, "line", again["size"])
    return repeats.groupBy(*KEY).agg(F.collect_set(F.struct("line", "size")).alias("runs"))


def remove_repeated_lines(documents: DataFrame) -> DataFrame:
    """Remove runs of two or more lines that stand earlier in the collection.

    Lines end at ``\\n``. Every two consecutive lines that aren't both blank are compared, so that every
    line of a repeated run of any length goes, wherever the run begins and ends. Of equal pairs of lines
    the first stays, by doc_id (NULL first), a hash of the text, and position; the others are removed,
    also within one document, unless they share a line with the first. A text of one line, NULL or empty, and
    a run of blank lines have nothing to remove. Rows equal in id and text count as one document and
    are treated alike.

    Returns all columns of ``documents`` with ``text`` replaced, and one struct ``line_dedup``
    (n_lines, n_removed); other columns may have any names but that. An empty table stays empty.

    The table of pairs holds hashes, not text, and is combined before it shuffles; only repeated runs
    are cut out and compared byte by byte, and the join broadcasts the most frequent pairs, so none of them
    fills one task. Rows are told apart by doc_id and a 64-bit hash of the text. Where
    repeats stand is counted and, if few, broadcast, so that no text is shuffled; beyond that the same
    joins shuffle the texts.
    """
    text_hash = F.xxhash64("text")
    keyed = documents.select("doc_id", text_hash.alias("text_hash"), "text")
    repeats = saved(repeated_runs(keyed), "repeats")
    rows = documents.select(F.struct("*").alias("row"), "doc_id", text_hash.alias("text_hash"))
    repeats = _broadcast_if_short(repeats, "runs")
    matched = rows.join(repeats, same_keys(rows, repeats, KEY), "left")
    without = F.pandas_udf(_without, "text string, n_lines long, n_removed long")
    done = matched.select("row", without(F.col("row.text"), F.col("runs.line"), F.col("runs.size")).alias("cut"))
    kept = [
        F.col("cut.text") if name == "text" else F.col(f"row.`{name}`") for name in documents.columns
    ]
    counts = F.struct(F.col("cut.n_lines"), F.col("cut.n_removed"))
    return done.select(*kept, counts.alias("line_dedup"))
