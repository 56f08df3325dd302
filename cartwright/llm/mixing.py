"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, join_counted, saved, word_count

#: Expected copies are whole multiples of 1/SCALE, so that prefix sums are exact in integers.
SCALE = 2**24


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float, cap: float
) -> DataFrame:
    """Share ``share`` times all sizes among the sources by weight, at most ``cap`` times a size each.

    ``sizes`` has one row per source: ``source`` and ``source_size``. Weights repeat in the order of
    the sources by code point, NULL last. What a capped source can't take is shared among the others
    by weight, until none is above its cap. In ascending order of cap over weight, that ends at the
    first source which stays below its cap when all before it are capped: the level found there holds
    for it and all after it. Adds ``weight`` and ``target``.

    The window runs over one row per source, never over documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    everything = W.partitionBy()
    ranked = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place))
    ranked = ranked.withColumn("full", F.col("source_size") * F.lit(float(cap)))
    before = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = before.rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(share))
    left = left - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    ranked = ranked.withColumn("level", left / weight_left)
    fits = F.col("level") * F.col("weight") <= F.col("full")
    level = F.max(F.when(fits, F.col("level"))).over(everything)
    target = F.coalesce(F.least(F.col("full"), level * F.col("weight")), F.col("full"))
    return ranked.withColumn("target", target).select("source", "source_size", "weight", "target")


def mix(
    documents: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    seed: str = "mix",
    rows_per_chunk: int = 100_000,
) -> DataFrame:
    """How often each document goes into the mix.

    A document's expected copies are its source's target over its source's size. Within a source
    the documents stand in one order, by size, then by a hash of their id; their expected copies are
    summed up along it from one offset per source, and a document is taken once for every integer
    that its interval crosses. As neighbours have about the same size, the words taken from a source
    differ from its target by no more than about its largest document.

    The prefix sums need no sort of a whole source. Documents are counted by (source, size, chunk),
    where a chunk is a range of the hash and a size that many documents share has several; the counts
    are summed up along a source; and documents are numbered only within their chunk. The offset is a
    hash of ``seed`` and the source, so a rerun, also of one lost task, takes the same documents.

    Returns one row per input row: doc_id, source, size (words; 0 for NULL or empty text), source_size,
    target, copies and taken (copies times size). No document has more than ``cap`` copies. NULL is a
    source of its own; a source without words has target 0 and nothing of it is taken. Repeated rows
    count one by one. An empty table gives no rows. Other columns don't matter.
    """
    sized = saved(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"
    )
    counted = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    counted = saved(counted, "counts").withColumns(
        {
            "s": F.coalesce("source", F.lit("")),
            "no_s": F.col("source").isNull(),
            "chunks": F.ceil(F.col("n") / rows_per_chunk).cast("long"),
        }
    )
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = saved(source_targets(sizes, weights, share, cap), "targets")
    rated = targets.select(
        F.coalesce("source", F.lit("")).alias("s"),
        F.col("source").isNull().alias("no_s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * SCALE))
        .otherwise(0)
        .cast("long")
        .alias("rate"),
    ).withColumn(
        "start", _fraction(F.concat(F.lit(seed), F.col("no_s").cast("string"), F.col("s")))
    )
    hashed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = (
        sized.withColumns(
            {
                "s": F.coalesce("source", F.lit("")),
                "no_s": F.col("source").isNull(),
                "mark": hashed,
            }
        )
    )
    same_size = ["s", "no_s", "size"]
    placed = (
        join_counted(placed, counted.select(*same_size, "chunks", "n"), same_size)
        .drop("n")
        .withColumn("chunk", F.floor(_fraction_of(F.col("mark")) * F.col("chunks") / SCALE))
    )
    chunk = ["s", "no_s", "size", "chunk"]
    along = W.partitionBy("s", "no_s").orderBy("size", "chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*chunk)
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
        .drop("n")
    )
    within = W.partitionBy(*chunk).orderBy("mark", "doc_id")
    numbered = placed.withColumn("at", F.row_number().over(within)).join(offsets, chunk)
    numbered = numbered.join(broadcast_if_small(rated), ["s", "no_s"])
    last = F.col("rate") * (F.col("before") + F.col("at")) + F.col("start")
    crossed = F.shiftright(last, 24) - F.shiftright(last - F.col("rate"), 24)
    return numbered.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        crossed.alias("copies"),
        (crossed * F.col("size")).alias("taken"),
    )




def _fraction_of(mark):
    """A number below SCALE from the first six digits of an MD5."""
    return F.conv(F.substring(mark, 1, 6), 16, 10).cast("long")


def _fraction(text):
    return _fraction_of(F.md5(text))


def emit(documents: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents of the mix, one row per copy, with ``copy`` counting from 1.

    Rows of ``documents`` are matched by doc_id, which must be unique and not NULL here. Other columns
    may have any names; one named ``copy`` is replaced.
    """
    wanted = mixed.filter("copies > 0").select("doc_id", "copies")
    rows = documents.select("doc_id", F.struct("*").alias("row")).join(wanted, "doc_id")
    numbers = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    kept = [F.col(f"row.`{name}`") for name in documents.columns if name != "copy"]
    return rows.select(*kept, numbers)
