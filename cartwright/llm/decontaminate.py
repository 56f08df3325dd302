"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, only, saved

#: Words of a shingle.
SHINGLE = 5
#: Items with fewer shingles are looked up by all of them, as a few minima could miss one.
FEW = 8
#: The items' shingles are broadcast if they take at most so many bytes in all, counted with 16 more for each.
ITEM_BYTES = 64_000_000
#: Documents fall into partitions by the power of two of their number of shingles.
SIZES = range(0, 32)


def words(text: Column) -> Column:
    """Runs of letters, marks and digits, lower-cased; none for NULL."""
    split = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.array_remove(split, "")


def _shingle_hashes() -> Column:
    """Of the column ``words``: a hash of every run of SHINGLE words, of all of them if fewer."""
    return F.expr(
        f"""CASE WHEN size(words) = 0 THEN array()
        WHEN size(words) < {SHINGLE} THEN array(xxhash64(size(words), array_join(words, ' ')))
        ELSE transform(sequence(0, size(words) - {SHINGLE}),
          i -> xxhash64({', '.join(f'words[i + {k}]' for k in range(SHINGLE))})) END"""
    )


def _shingles() -> Column:
    """The distinct shingles of ``words`` as text."""
    return F.expr(
        f"""CASE WHEN size(words) = 0 THEN array()
        WHEN size(words) < {SHINGLE} THEN array(array_join(words, ' '))
        ELSE array_distinct(transform(sequence(0, size(words) - {SHINGLE}),
          i -> concat_ws(' ', slice(words, i + 1, {SHINGLE})))) END"""
    )


def _minima() -> Column:
    """The MinHash signature of the sorted hashes ``sorted`` under the size class ``class``.

    One hash serves for all permutations: its first bits choose a bin and the smallest value of each
    bin is kept. There are two to four bins for a shingle of the largest document of the class.
    """
    bin_of = "shiftrightunsigned({}, 62 - class)"
    return F.expr(
        f"""filter(sorted, (h, i) -> i = 0
        OR {bin_of.format('h')} <> {bin_of.format('sorted[i - 1]')})"""
    )


def contaminated(
    documents: DataFrame, benchmark: DataFrame, threshold: float = 0.8
) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains.

    An item is contained if at least ``threshold`` of its distinct five-word shingles are among the
    document's. Words are runs of letters, marks and digits, lower-cased; fewer than five words make
    one shingle, all of them.

    The search is MinHash over documents partitioned by size: the larger a document, the more bins
    its signature has, so that a short item's minima are found as surely in a long document as in
    a short one. An item's signature is made for every size class, and a document is a candidate if
    any minimum agrees. A contained shingle is a minimum of its bin with probability 0.79 at least,
    so an item of eight shingles, 0.8 of them present, is missed with probability below 0.0001, a
    longer one with much less. Items of fewer shingles are looked up by all shingles instead, without
    loss. Candidates are then verified by their exact shingle sets.

    Returns doc_id, item_id, item_shingles, shared and containment, one row per pair of ids (the
    largest containment if ids repeat). A document or item without words, NULL or empty, is in no
    pair; NULL ids are ids like others; an empty table gives no rows; other columns don't matter.

    The items' signatures are counted and broadcast if few; then the documents are not shuffled at
    all in the search, and only candidates in the verification. Else both are shuffle joins on the
    hash, and a hash that a third of all documents hold can be split.
    """
    listed = saved(
        benchmark.select("item_id", words(F.col("text")).alias("words")).select(
            "item_id",
            _shingles().alias("item"),
            F.sort_array(F.array_distinct(_shingle_hashes())).alias("sorted"),
        ),
        "items",
    )
    items = listed.filter("size(item) > 0")
    # Arrays are exploded with explode_outer: for explode Spark adds a filter on the array's size and
    # pushes it down to the text, where it would split the text again for every word.
    classed = items.filter(F.size("item") >= FEW).withColumn("class", F.explode(F.lit(list(SIZES))))
    index = saved(
        classed.select("item_id", "class", F.explode_outer(_minima()).alias("hash")), "item-minima"
    )
    split = documents.select("doc_id", words(F.col("text")).alias("words"))
    hashed = split.select("doc_id", F.sort_array(_shingle_hashes()).alias("sorted"))
    # Never NULL, or the join's filter on it would be pushed down in the same way.
    size_class = F.coalesce(F.ceil(F.log2(F.size("sorted"))).cast("int"), F.lit(0))
    sized = hashed.select("doc_id", "sorted", size_class.alias("class"))
    signed = sized.select("doc_id", "class", F.explode_outer(_minima()).alias("hash"))
    found = signed.join(broadcast_if_small(index), ["class", "hash"]).select("doc_id", "item_id")
    few = saved(
        items.filter(F.size("item") < FEW).select("item_id", F.explode("sorted").alias("hash")),
        "short-items",
    )
    if not few.isEmpty():
        every = hashed.select("doc_id", F.explode_outer("sorted").alias("hash"))
        found = found.union(every.join(broadcast_if_small(few), "hash").select("doc_id", "item_id"))
    candidates = saved(found.distinct(), "candidates")
    asked = candidates.groupBy(F.col("doc_id").alias("candidate")).agg(
        F.collect_set(F.struct("item_id")).alias("asked")
    )
    texts = only(documents.select("doc_id", "text"), candidates, ["doc_id"])
    checked = (
        texts.join(asked, F.col("doc_id").eqNullSafe(F.col("candidate")))
        .select("doc_id", "asked", words(F.col("text")).alias("words"))
        .select("doc_id", "asked", _shingles().alias("shingles"))
        .select("doc_id", "shingles", F.explode_outer("asked.item_id").alias("asked_id"))
    )
    size = F.aggregate("item", F.lit(0).cast("long"), lambda total, x: total + F.octet_length(x) + 16)
    compared = items.select("item_id", "item")
    if (items.agg(F.sum(size)).first()[0] or 0) <= ITEM_BYTES:
        compared = F.broadcast(compared)
    exact = checked.join(compared, F.col("asked_id").eqNullSafe(F.col("item_id")))
    shared = F.size(F.array_intersect("shingles", "item")).cast("long")
    best = F.max_by(F.struct("item_shingles", "shared", "containment"), F.col("containment"))
    return (
        exact.select(
            "doc_id",
            "item_id",
            F.size("item").cast("long").alias("item_shingles"),
            shared.alias("shared"),
        )
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", "best.*")
        .filter(F.col("containment") >= threshold)
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, threshold: float = 0.8
) -> DataFrame:
    """The documents that contain no benchmark item; a NULL id is kept unless such a row contains one.

    All columns stay, whatever their names.
    """
    found = saved(contaminated(documents, benchmark, threshold).select("doc_id").distinct(), "leaks")
    named = broadcast_if_small(found.withColumnRenamed("doc_id", "leaking"))
    return documents.join(named, documents["doc_id"].eqNullSafe(named["leaking"]), "left_anti")
