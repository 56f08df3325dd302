"""Removal of byte strings that stand earlier in the collection, by column-wise sorting of suffixes.

Building one Burrows-Wheeler transform of a collection by inserting one symbol per document each round
needs as many passes over all of it as the longest document has bytes. As only matches of a fixed
length count here, suffixes are compared on that many bytes only, in shards that hold all suffixes
which can be equal, and a round takes in a column of eight bytes of every suffix of the shard at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, join_counted, only, same_keys, saved

#: What identifies a row: its id and a hash of its text. Rows equal in both count as one document.
KEY = ["doc_id", "text_hash"]
_ID = "doc_id long, text_hash long"

#: Bytes of the strings that choose a suffix's shard.
ANCHOR = 24
#: An anchor that occurs more often is not gathered in one task.
HOT = 20_000
#: Suffixes that a task compares at once, about.
BATCH = 1_000_000

_PLACE = np.uint64(0xFFFFF)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < size:
        inverse = pow(_BASE, -1, 2**64)
        for base in (_BASE, inverse):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            _POWERS.append(np.cumprod(row))
        del _POWERS[:-2]
    return _POWERS[0][:size], _POWERS[1][:size]


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every run of ANCHOR bytes, from prefix sums."""
    up, down = _powers(max(len(data) + 1, 1 << 17))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    found = (sums[ANCHOR:] - sums[:-ANCHOR]) * down[: len(data) - ANCHOR + 1]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(29))


def anchored_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts of ``length``-byte strings that have one anchor: (hash, first, last, anchor).

    The anchor of a string is the run of ANCHOR bytes in it with the smallest hash, the first of
    equal ones: equal strings have equal anchors at equal places.
    """
    parts, step = [], int(_PLACE) - length
    for at in range(0, max(len(data) - length + 1, 0), step):
        hashes = _anchor_hashes(data[at : at + step + length - 1])
        marked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        width, least = length - ANCHOR + 1, marked
        span = 1
        while 2 * span <= width:
            least = np.minimum(least[: len(least) - span], least[span:])
            span *= 2
        rest = width - span
        if rest:
            least = np.minimum(least[: len(least) - rest], least[rest:])
        place = (least & _PLACE).astype(np.int64)
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        lasts = np.append(firsts[1:], len(place)) - 1
        anchor = place[firsts]
        parts.append((hashes[anchor].view(np.int64), firsts + at, lasts + at, anchor + at))
    if not parts:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(column) for column in zip(*parts))


def equal_strings(
    buffer: np.ndarray, starts: np.ndarray, shard: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """(indices, class): the strings of ``length`` bytes at ``starts`` that equal another of their shard.

    Column-wise: a round takes the next column of every string, and the rank of a string follows from
    its rank so far and the column's symbol. Strings with a rank of their own leave.
    """
    at = np.arange(len(starts))
    _, rank = np.unique(shard, return_inverse=True)
    words = np.lib.stride_tricks.sliding_window_view(buffer, 8)
    # The last column overlaps the one before it if length is no multiple of eight.
    for column in [*range(0, length - 7, 8), length - 8]:
        symbol = np.ascontiguousarray(words[starts[at] + column]).view(np.uint64).ravel()
        order = np.lexsort((symbol, rank))
        new = np.empty(len(order), dtype=bool)
        if len(order):
            new[0] = True
            new[1:] = (np.diff(rank[order]) != 0) | (symbol[order][1:] != symbol[order][:-1])
        numbers = np.cumsum(new) - 1
        alone = np.bincount(numbers, minlength=1)[numbers] < 2
        at, rank = at[order][~alone], numbers[~alone]
    return at, rank


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Sorted numbers as (first, last) of runs of consecutive ones."""
    cut = np.flatnonzero(np.diff(starts) > 1) + 1
    return [(int(part[0]), int(part[-1])) for part in np.split(starts, cut) if len(part)]


def _list_anchors(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in np.array_split(np.arange(len(batch)), max(1, len(batch) // 500)):
                frames = []
                for doc_id, text_hash, data in batch.iloc[some].itertuples(index=False, name=None):
                    anchor, first, _, _ = anchored_runs(np.frombuffer(data, np.uint8), length)
                    frames.append(
                        pd.DataFrame({"anchor": anchor, "first": first, "doc_id": doc_id, "text_hash": text_hash})
                    )
                if frames:
                    yield pd.concat(frames).astype({"doc_id": "Int64"})

    return run


def _cut_contexts(length: int):
    """The bytes of the strings of every listed run."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["anchor", "hot", "doc_id", "text_hash", "first", "place", "context"]
        for batch in batches:
            rows, size = [], 0
            for doc_id, text_hash, data, wanted, hot in batch.itertuples(index=False, name=None):
                runs = anchored_runs(np.frombuffer(data, np.uint8), length)
                is_hot = dict(zip(wanted, hot))
                listed = np.flatnonzero(np.isin(runs[1], wanted))
                for anchor, first, last, place in zip(*(column[listed].tolist() for column in runs)):
                    context = data[first : last + length]
                    rows.append((anchor, is_hot[first], doc_id, text_hash, first, place - first, context))
                    size += len(context)
                if size > 4_000_000:
                    yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return run


def _compare(rows: list[tuple], length: int) -> list[tuple]:
    """(doc_id, text_hash, first, last) of starts of strings that stand earlier in these rows.

    ``rows`` hold whole shards: (anchor, doc_id, text_hash, first, place, context), in the order of
    the collection within a shard.
    """
    found, known, shards = [], set(), {}
    for anchor, doc_id, text_hash, first, place, context in rows:
        if (anchor, place, context) in known:
            found.append((doc_id, text_hash, first, first + len(context) - length))
            continue
        known.add((anchor, place, context))
        shards.setdefault(anchor, []).append(((doc_id, text_hash, first), context))
    several = [(anchor, *one) for anchor, own in shards.items() if len(own) > 1 for one in own]
    if not several:
        return found
    buffer = np.frombuffer(b"".join(c for _, _, c in several), dtype=np.uint8)
    sizes = np.array([len(c) for _, _, c in several])
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(several)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + offset
    shard = np.array([anchor for anchor, _, _ in several])[row]
    at, rank = equal_strings(buffer, starts, shard, length)
    if not len(at):
        return found
    order = np.lexsort((at, rank))
    at, rank = at[order], rank[order]
    later = np.sort(at[1:][rank[1:] == rank[:-1]])
    numbers, begins = np.unique(row[later], return_index=True)
    for i, own in zip(numbers.tolist(), np.split(offset[later], begins[1:])):
        doc_id, text_hash, first = several[i][1]
        found += [(doc_id, text_hash, first + a, first + b) for a, b in _runs(own)]
    return found


def _compare_shards(length: int):
    """Compare whole shards, which come sorted, some at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*KEY, "first", "last"]
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                if size > BATCH and row[0] != held[-1][0]:
                    yield pd.DataFrame(_compare(held, length), columns=names).astype({"doc_id": "Int64"})
                    held, size = [], 0
                held.append((row[0], None if pd.isna(row[1]) else int(row[1]), *row[2:]))
                size += len(row[-1]) - length + 1
        if held:
            yield pd.DataFrame(_compare(held, length), columns=names).astype({"doc_id": "Int64"})

    return run


def _hash_strings(length: int):
    """A 128-bit hash of every string of the contexts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in np.array_split(np.arange(len(batch)), max(1, len(batch) // 1000)):
                rows = [
                    (doc_id, text_hash, first + k, xxhash.xxh3_128_digest(context[k : k + length]))
                    for doc_id, text_hash, first, context in batch.iloc[some].itertuples(index=False, name=None)
                    for k in range(len(context) - length + 1)
                ]
                frame = pd.DataFrame(rows, columns=[*KEY, "first", "digest"])
                yield frame.astype({"doc_id": "Int64"})

    return run


def repeated_strings(documents: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash, first, last): starts of strings that stand earlier, in ``documents`` (KEY, data)."""
    anchors = documents.mapInPandas(_list_anchors(length), f"anchor long, first int, {_ID}")
    anchors = saved(anchors, "anchors")
    often = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    often = saved(often.withColumn("hot", F.col("n") > HOT), "often")
    listed = join_counted(anchors, often, ["anchor"]).groupBy(*KEY).agg(
        F.collect_list(F.struct("first", "hot")).alias("runs")
    )
    listed = saved(listed, "runs")
    named = only(documents, listed, KEY)
    asked = named.join(listed, same_keys(named, listed, KEY)).select(
        named.doc_id, named.text_hash, "data", "runs.first", "runs.hot"
    )
    contexts = saved(
        asked.mapInPandas(
            _cut_contexts(length),
            f"anchor long, hot boolean, {_ID}, first int, place int, context binary",
        ),
        "contexts",
    )
    usual = (
        contexts.filter("NOT hot")
        .select("anchor", *KEY, "first", "place", "context")
        .repartition("anchor")
        .sortWithinPartitions("anchor", F.col("doc_id").asc_nulls_first(), "text_hash", "first")
        .mapInPandas(_compare_shards(length), f"{_ID}, first int, last int")
    )
    strings = contexts.filter("hot").select(*KEY, "first", "context").mapInPandas(
        _hash_strings(length), f"{_ID}, first int, digest binary"
    )
    at = F.struct(*KEY, "first")
    earliest = strings.groupBy("digest").agg(F.min(at).alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    hot = join_counted(strings, saved(earliest, "earliest"), ["digest"]).filter(~at.eqNullSafe(F.col("earliest")))
    return usual.union(hot.select(*KEY, "first", F.col("first").alias("last")))


def _kept(length: int):
    """What is left of a text without the bytes that the strings at the listed starts cover."""

    def measure(data: bytes, firsts: np.ndarray, lasts: np.ndarray) -> tuple[bytes, int, int]:
        edges = np.zeros(len(data) + 1, dtype=np.int64)
        np.add.at(edges, firsts, 1)
        np.add.at(edges, lasts + length, -1)
        gone = np.cumsum(edges[:-1]) > 0
        spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
        return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, data, firsts, lasts in batch.itertuples(index=False, name=None):
                kept, removed, spans = measure(data, firsts, lasts)
                rows.append((doc_id, len(data), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return run


def remove_repeated_strings(documents: DataFrame, length: int = 100) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts earlier.

    Texts are UTF-8 bytes (NULL: empty), and matches never cross documents. Earlier is a smaller doc_id
    (NULL first; of one id by a hash of the text), or an earlier start in the same document; strings
    are judged on the input. Rows equal in id and text count as one document and are treated alike.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept (the
    remaining bytes); one row per input row. A text shorter than ``length`` keeps all; an empty table
    gives no rows; other columns don't matter.

    Whole copies of an earlier text are found by SHA-256 first. Of the rest only anchors are shuffled,
    one for about 40 bytes, and combined. Strings with a repeated anchor go to its shard, where copies
    of a whole context fall together and what is left is sorted column by column on its bytes. An
    anchor of more than HOT occurrences is not gathered: its strings are grouped by a 128-bit hash. The joins
    with what is frequent broadcast it, so no task gets all rows of an anchor, a string or a sum. Rows are told
    apart by doc_id and a 64-bit hash of the text.
    """
    if length < ANCHOR + 8:
        raise ValueError(f"strings must have {ANCHOR + 8} bytes or more")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), data.alias("data"))
    sums = saved(whole.select(*KEY, F.sha2("data", 256).alias("sum"), F.length("data").alias("size")), "sums")
    known = F.struct(*KEY)
    firsts = sums.groupBy("sum").agg(F.min(known).alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    firsts = saved(firsts, "firsts")
    copies = join_counted(sums.filter(F.col("size") >= length), firsts, ["sum"])
    copies = saved(copies.filter(~known.eqNullSafe(F.col("earliest"))).select(*KEY).distinct(), "copies")

    single = whole.filter(F.length("data") >= length)
    gone = broadcast_if_small(copies)
    single = single.join(gone, same_keys(single, gone, KEY), "left_anti").dropDuplicates(KEY)
    found = repeated_strings(single, length).groupBy(*KEY).agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )
    found = saved(found, "spans")

    named = only(whole, found, KEY)
    cut = named.join(found, same_keys(named, found, KEY)).select(
        named.doc_id, "data", "runs.first", "runs.last"
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    cut = cut.mapInPandas(_kept(length), schema)
    touched = broadcast_if_small(found.select(*KEY))
    rest = whole.join(touched, same_keys(whole, touched, KEY), "left_anti")
    marked = broadcast_if_small(copies).withColumn("copy", F.lit(True))
    rest = rest.join(marked, same_keys(rest, marked, KEY), "left").select(rest.doc_id, "data", "copy")
    size = F.length("data").cast("long")
    kept = F.when(F.col("copy"), F.lit("").cast("binary")).otherwise(F.col("data"))
    rest = rest.select(
        "doc_id",
        size.alias("n_bytes"),
        F.when(F.col("copy"), size).otherwise(0).cast("long").alias("n_removed"),
        F.when(F.col("copy"), 1).otherwise(0).cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
        kept.alias("kept"),
    )
    return cut.union(rest)
