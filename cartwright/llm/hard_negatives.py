"""Hard negatives: for every anchor and positive the best rows of other labels below the positive."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import saved

#: Rows of embeddings and anchors that a task scores against each other at most, apart from hashing's spread.
ROWS_PER_CELL = 131_072
ANCHORS_PER_CELL = 32_768
#: Scores that are held at a time.
_SCORES = 1 << 22
#: Scaled components beyond this, either way, count as not finite: scores then fit 64 bits.
LARGEST = 1 << 24

LISTED = "anchor_id long, slot int, vec_id long, score long"


@dataclass(frozen=True)
class Mining:
    """``positives`` and ``negatives`` are how many an anchor and a pair get. A negative's score is at least
    ``least`` percent of its positive's, and at most the positive's. Rows whose id is divisible by ``every``
    are the anchors, and components are multiplied by ``scale`` before they are cut to whole numbers."""

    positives: int = 5
    negatives: int = 5
    least: int = 80
    every: int = 100
    scale: int = 256


def _quantized(scale: int):
    """Rows with usable vectors as bytes of 32-bit numbers; rows that repeat in a batch come once."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec_ids, labels = (batch.column(name).to_pylist() for name in ("vec_id", "label"))
            vectors = batch.column("vector")
            lengths = vectors.value_lengths().to_pylist()
            # NULL components become NaN, and so not finite.
            values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            with np.errstate(all="ignore"):
                values = np.floor(scale * values)
                usable = np.abs(values) <= LARGEST
            whole = np.where(usable, values, 0).astype("<i4")
            rows, at = {}, 0
            for vec_id, label, size in zip(vec_ids, labels, lengths):
                if usable[at : at + size].all():
                    rows[(vec_id, label, whole[at : at + size].tobytes())] = None
                at += size
            columns = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.binary()))],
                ["vec_id", "label", "vector"],
            )

    return packed


def _shapes(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers sorted by id, their matrix, anchor numbers, their matrix) for each length of vectors."""
    sides = []
    for side in (rows, anchors):
        vectors = np.array(side.column("vector").to_pylist() + [None], object)[:-1]
        sides.append((vectors, np.array([len(v) for v in vectors], np.int64), side.column("vec_id").to_numpy()))
    (row_vectors, row_sizes, row_ids), (anchor_vectors, anchor_sizes, _) = sides
    for size in np.intersect1d(row_sizes, anchor_sizes):
        some = np.flatnonzero(row_sizes == size)
        some = some[np.argsort(row_ids[some], kind="stable")]
        asked = np.flatnonzero(anchor_sizes == size)
        matrices = (
            np.frombuffer(b"".join(vectors[at]), "<i4").reshape(len(at), size // 4)
            for vectors, at in ((row_vectors, some), (anchor_vectors, asked))
        )
        yield some, next(matrices), asked, next(matrices)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where every sum is below 2^53."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class _Best:
    """The first ``k`` of each (anchor, slot), by score and then id, of rows that come in by ascending id."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.slots, self.k = slots, k
        self.place = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.vec_id = np.empty(0, np.int64)
        # What a score has to exceed: once a list is full, an equal score of a larger id comes too late.
        self.bar = np.full(anchors * slots, np.iinfo(np.int64).min)

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        place = anchor * self.slots + slot
        over = score > self.bar[place]
        place = np.append(self.place, place[over])
        score = np.append(self.score, score[over])
        vec_id = np.append(self.vec_id, vec_id[over])
        order = np.lexsort((vec_id, -score, place))
        place, score, vec_id = place[order], score[order], vec_id[order]
        new = np.ones(len(place), bool)
        new[1:] = (np.diff(place) != 0) | (np.diff(score) != 0) | (np.diff(vec_id) != 0)
        place, score, vec_id = place[new], score[new], vec_id[new]
        starts = np.flatnonzero(np.append(True, np.diff(place) != 0)) if len(place) else np.empty(0, np.int64)
        rank = np.arange(len(place)) - np.repeat(starts, np.diff(np.append(starts, len(place))))
        kept = rank < self.k
        self.place, self.score, self.vec_id = place[kept], score[kept], vec_id[kept]
        full = rank == self.k - 1
        self.bar[place[full]] = score[full]

    def table(self, anchor_ids: np.ndarray) -> pa.Table:
        return pa.table(
            {
                "anchor_id": pa.array(anchor_ids[self.place // self.slots], pa.int64()),
                "slot": pa.array((self.place % self.slots).astype(np.int32), pa.int32()),
                "vec_id": pa.array(self.vec_id, pa.int64()),
                "score": pa.array(self.score, pa.int64()),
            }
        )


def _positives(k: int):
    """The first ``k`` other rows of every anchor's label in a cell."""

    def listed(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        best = _Best(anchors.num_rows, 1, k)
        ids, labels = (rows.column(name).to_numpy() for name in ("vec_id", "label"))
        anchor_ids, anchor_labels = (anchors.column(name).to_numpy() for name in ("vec_id", "label"))
        for some, vectors, asked, wanted in _shapes(rows, anchors):
            for label in np.intersect1d(labels[some], anchor_labels[asked]):
                mine, theirs = labels[some] == label, anchor_labels[asked] == label
                _by_tiles(best, some[mine], vectors[mine], asked[theirs], wanted[theirs], ids, anchor_ids, None, None)
        return best.table(anchor_ids)

    return listed


def _slotted(k: int, least: int, most_slots: int):
    """The first ``k`` rows of other labels of every anchor's slots in a cell."""

    def listed(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        best = _Best(anchors.num_rows, most_slots, k)
        ids, labels = (rows.column(name).to_numpy() for name in ("vec_id", "label"))
        anchor_ids, anchor_labels = (anchors.column(name).to_numpy() for name in ("vec_id", "label"))
        # Descending; where an anchor has fewer positives the last limits are below every score.
        limits = np.full((anchors.num_rows, most_slots), np.iinfo(np.int64).min)
        for i, found in enumerate(anchors.column("limits").to_pylist()):
            limits[i, : len(found)] = found
        bottom = np.array([min(map(lambda p: lowest(p, least), x)) for x in anchors.column("limits").to_pylist()], np.int64)
        for some, vectors, asked, wanted in _shapes(rows, anchors):
            other = (labels, anchor_labels)
            _by_tiles(best, some, vectors, asked, wanted, ids, anchor_ids, other, (limits, bottom))
        return best.table(anchor_ids)

    return listed


def lowest(positive: int, least: int) -> int:
    """The smallest whole score of at least ``least`` percent of the positive's."""
    return -(-least * positive // 100)


def _by_tiles(best, some, vectors, asked, wanted, ids, anchor_ids, labels, windows) -> None:
    """Score rows against anchors, a bounded number at a time, and list what qualifies."""
    for low in range(0, len(asked), 4096):
        at = asked[low : low + 4096]
        step = max(1, _SCORES // max(1, len(at)))
        for start in range(0, len(some), step):
            tile = some[start : start + step]
            scores = _products(wanted[low : low + 4096], vectors[start : start + step])
            if windows is None:
                hit = anchor_ids[at][:, None] != ids[tile][None, :]
            else:
                limits, bottom = windows
                hit = labels[1][at][:, None] != labels[0][tile][None, :]
                hit &= (scores <= limits[at, 0][:, None]) & (scores >= bottom[at][:, None])
            a, r = np.nonzero(hit)
            found = scores[a, r]
            anchor = at[a]
            # A slot reaches from one positive's score down to just above the next one's.
            slot = np.zeros(len(a), np.int64) if windows is None else (limits[anchor] >= found[:, None]).sum(1) - 1
            best.add(anchor, slot, found, ids[tile][r])


def _scored(rows: DataFrame, anchors: DataFrame, shape: tuple[int, int], work) -> DataFrame:
    """``work`` over every cell of the grid of row strips and anchor ranges: each row meets each anchor once."""
    strips, ranges = shape
    strip, span = (F.pmod(F.xxhash64("vec_id"), F.lit(n)) for n in (strips, ranges))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("strip", strip).withColumn("range", every(ranges))
    right = anchors.withColumn("range", span).withColumn("strip", every(strips))
    cell = (F.col("range") * strips + F.col("strip")).alias("cell")
    left, right = (side.select("*", cell).drop("range", "strip") for side in (left, right))
    # Rows without anchors in their cell, or the reverse, find nothing.
    return left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(work, LISTED)


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return df.withColumn("place", place).filter(F.col("place") <= k)


def mine(embeddings: DataFrame, how: Mining = Mining()) -> DataFrame:
    """Hard negatives of every anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).

    ``embeddings`` has ``vec_id``, ``label`` and ``embedding``; other columns aren't read. A row's score is the inner
    product of its whole-numbered vector with the anchor's. An anchor's positives are the first rows of
    its label, other than itself, its negatives to a positive the first rows of other labels whose scores
    are within the positive's window. Higher scores come first, equal ones by smaller id.

    Rows without an id or label, without a vector, or with a component that is NULL, not finite or beyond
    2^24 once scaled take no part. Vectors of different lengths, an empty one included, have no score with
    each other. Rows that repeat count once, as do rows with one id and equal scores; of different rows
    that share an anchor's id, the one with the smallest label and vector is the anchor. A pair without
    negatives, an anchor without positives, an empty table: no rows.

    The anchors are a stated query set and are scored against all rows block by block: rows fall into strips and
    anchors into ranges by a hash of their ids, and a task scores one strip against one range, both of a
    bounded size, whatever the table's. The positives' scores are upper limits that cut the
    scores into disjoint slots. A task keeps the first few rows of every slot and hands on nothing else; these are
    combined by slot, and the rows at or below a limit are the slots from it down, merged. What
    meets at an anchor is a few rows per strip, cut to a few per slot before and after the shuffle.
    """
    spark = embeddings.sparkSession
    usable = embeddings.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    rows = usable.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").alias("vector"),
    )
    rows = saved(rows.mapInArrow(_quantized(how.scale), "vec_id long, label long, vector binary"), "quantized")
    return _mined(rows, how, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _mined(rows: DataFrame, how: Mining, tasks: int) -> DataFrame:
    least_of = F.min(F.struct("label", "vector")).alias("own")
    anchors = rows.filter(F.col("vec_id") % how.every == 0).groupBy("vec_id").agg(least_of)
    anchors = saved(anchors.select("vec_id", "own.label", "own.vector"), "anchors")
    # Several cells per task, so that they even out.
    strips = max(4 * tasks, -(-rows.count() // ROWS_PER_CELL))
    shape = strips, max(1, -(-anchors.count() // ANCHORS_PER_CELL))
    near = _scored(rows, anchors, shape, _positives(how.positives))
    positives = _first(near, how.positives, "anchor_id")
    pairs = F.array_sort(F.collect_list(F.struct("place", F.col("vec_id").alias("positive_id"), "score"))).alias("pairs")
    positives = saved(positives.groupBy("anchor_id").agg(pairs), "positives")
    limits = positives.select(F.col("anchor_id").alias("vec_id"), F.col("pairs.score").alias("limits"))
    below = _scored(rows, anchors.join(limits, "vec_id"), shape, _slotted(how.negatives, how.least, how.positives))
    slots = _first(below, how.negatives, "anchor_id", "slot")
    in_order = F.struct((-F.col("score")).alias("down"), "vec_id", "slot")
    slots = slots.groupBy("anchor_id").agg(F.array_sort(F.collect_list(in_order)).alias("slots"))
    each = positives.join(slots, "anchor_id").select("anchor_id", "slots", F.inline("pairs"))
    # Slots from the positive's own on, in descending order of scores.
    suffix = F.filter("slots", lambda row: row["slot"] >= F.col("place") - 1)
    first = F.slice(suffix, 1, how.negatives)
    exact = "decimal(38,0)"
    within = F.filter(first, lambda row: -row["down"].cast(exact) * 100 >= F.col("score").cast(exact) * how.least)
    return each.select("anchor_id", "positive_id", "score", F.posexplode(within).alias("at", "negative")).select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("negative.vec_id").alias("negative_id"),
        F.col("score").alias("positive_score"),
        (-F.col("negative.down")).alias("negative_score"),
    )
