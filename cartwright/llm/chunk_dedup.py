"""Exact dedup by recipes: ordered lists of verified content-defined chunks."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, same_keys, saved

#: A chunk has at least LEAST and at most MOST bytes, apart from a text's last; between these it ends
#: where the rolling hash of WINDOW bytes ends in BITS zero bits.
LEAST, MOST, BITS, WINDOW = 512, 8192, 10, 32
#: A recipe that more than this share of all rows have is joined by broadcast: fewer than SHARE are.
SHARE = 1000
#: Bytes of recipes that are broadcast at most.
BROADCAST_BYTES = 32 << 20

Hash = Callable[[bytes], bytes]

_STEP = 0x9E3779B1
_BLOCK = 1 << 20


def _byte_weights() -> np.ndarray:
    """A 32-bit number for every byte, by a multiplicative mix."""
    x = np.arange(1, 257, dtype=np.uint32) * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


_WEIGHTS = _byte_weights()


def cut_candidates(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last WINDOW bytes ends in BITS zero bits.

    The hash of a window is the sum of its bytes' weights times powers of a constant. Windows of one
    byte are joined to windows of two, four, and so on, a block of the data at a time.
    """
    found = []
    for start in range(0, len(data), _BLOCK):
        lead = min(start, WINDOW - 1)
        rolled = _WEIGHTS[data[start - lead : start + _BLOCK]]
        width, power = 1, _STEP
        while width < WINDOW:
            joined = rolled.copy()
            joined[width:] += np.uint32(power) * rolled[:-width]
            rolled, width, power = joined, 2 * width, power * power % (1 << 32)
        at = np.flatnonzero((rolled[lead:] >> np.uint32(32 - BITS)) == 0)
        found.append(at + (start + 1))
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunk_ends(candidates: list[int], start: int, end: int) -> Iterator[int]:
    """Where the chunks of the text from ``start`` to ``end`` end, among sorted candidates.

    A chunk is longer than the window, so no cut depends on bytes before the text, and equal texts
    are cut alike wherever they stand.
    """
    while end - start > LEAST:
        i = bisect_left(candidates, start + LEAST)
        most = min(start + MOST, end)
        start = candidates[i] if i < len(candidates) and candidates[i] <= most else most
        yield start
    if start < end:
        yield end


def _hash(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def _texts(column: pa.Array) -> Iterator[list[memoryview]]:
    """The chunks of every text of an Arrow array of binary values."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    low = int(offsets[0]) if len(column) else 0
    held = column.buffers()[2]
    data = memoryview(held)[low : int(offsets[-1])] if held is not None and len(column) else memoryview(b"")
    candidates = cut_candidates(np.frombuffer(data, np.uint8)).tolist()
    places = (offsets - low).tolist()
    for start, end in zip(places, places[1:]):
        chunks = []
        for cut in chunk_ends(candidates, start, end):
            chunks.append(data[start:cut])
            start = cut
        yield chunks


def _list_recipes(chunk_hash: Hash) -> Callable:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipes, digests = [], []
            for chunks in _texts(batch.column("text")):
                digest = hashlib.sha256()
                for chunk in chunks:
                    digest.update(chunk)
                digests.append(digest.hexdigest())
                recipes.append(b"".join(map(chunk_hash, chunks)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("mark"), batch.column("doc_id"), pa.array(digests, pa.string()), pa.array(recipes, pa.binary())],
                ["mark", "doc_id", "text_sha256", "recipe"],
            )

    return listed


def _list_chunks(chunk_hash: Hash) -> Callable:
    """Every chunk of a batch once, with its hash."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {bytes(chunk) for chunks in _texts(batch.column("text")) for chunk in chunks}
            held, size = [], 0
            for chunk in seen:
                held.append(chunk)
                size += len(chunk)
                if size >= 8 << 20:
                    yield _chunk_batch(held, chunk_hash)
                    held, size = [], 0
            yield _chunk_batch(held, chunk_hash)

    return listed


def _chunk_batch(chunks: list[bytes], chunk_hash: Hash) -> pa.RecordBatch:
    hashes = pa.array(list(map(chunk_hash, chunks)), pa.binary())
    return pa.RecordBatch.from_arrays([hashes, pa.array(chunks, pa.binary())], ["hash", "bytes"])


def _list_places(chunk_hash: Hash) -> Callable:
    """The chunks of every text with their places."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, digest, chunks in zip(
                batch.column("doc_id").to_pylist(), batch.column("text_sha256").to_pylist(), _texts(batch.column("text"))
            ):
                n = len(chunks)
                held = list(map(bytes, chunks))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc_id] * n, pa.int64()),
                        pa.array([digest] * n, pa.string()),
                        pa.array(range(n), pa.int32()),
                        pa.array(list(map(chunk_hash, held)), pa.binary()),
                        pa.array(held, pa.binary()),
                    ],
                    ["doc_id", "text_sha256", "at", "hash", "bytes"],
                )

    return listed


def verified_recipes(documents: DataFrame, chunk_hash: Hash = _hash) -> DataFrame:
    """(mark, doc_id, text_sha256, recipe) of every row: texts are equal where recipes are.

    A recipe is the ordered list of the identifiers of a text's chunks, and ``mark`` is a number
    that no other row has. A chunk's identifier is its hash, once all chunks have been compared: the
    distinct pairs of hash and bytes are counted by hash. Chunks that share a hash with others are
    numbered by their bytes, and a recipe with such chunks goes on with these numbers.
    """
    texts = documents.select(
        F.monotonically_increasing_id().alias("mark"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"),
    )
    listed = "mark long, doc_id long, text_sha256 string, recipe binary"
    recipes = saved(texts.mapInArrow(_list_recipes(chunk_hash), listed), "recipes")
    # The only shuffle of text: each chunk once from every task.
    chunks = texts.select("text").mapInArrow(_list_chunks(chunk_hash), "hash binary, bytes binary").distinct()
    shared = saved(chunks.groupBy("hash").count().filter("count > 1").select("hash"), "shared-hashes")
    if shared.isEmpty():
        return recipes
    named = texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "text")
    listed = "doc_id long, text_sha256 string, at int, hash binary, bytes binary"
    places = saved(
        named.mapInArrow(_list_places(chunk_hash), listed).join(broadcast_if_small(shared), "hash").distinct(), "places"
    )
    variants = places.select("hash", "bytes").distinct()
    number = F.row_number().over(Window.partitionBy("hash").orderBy("bytes"))
    numbered = places.join(variants.withColumn("variant", number), ["hash", "bytes"])
    told = numbered.groupBy("doc_id", "text_sha256").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("at", "variant"))).cast("array<string>"), "").alias("told")
    )
    found = recipes.join(told, same_keys(recipes, told, ["doc_id", "text_sha256"]), "left")
    length = F.concat(F.length("recipe").cast("string"), F.lit(":")).cast("binary")
    more = F.coalesce(F.col("told"), F.lit("")).cast("binary")
    full = F.concat(length, "recipe", more).alias("recipe")
    return saved(found.select("mark", recipes.doc_id, recipes.text_sha256, full), "recipes")


def find_copies(documents: DataFrame, chunk_hash: Hash = _hash) -> DataFrame:
    """Which rows of ``documents`` have equal texts, and which of them stays.

    Returns one row per row of ``documents``: doc_id, keep_id (the id of the row that stays, the
    largest of the group), group_size, kept, text_sha256. Texts are equal when identical; a NULL text
    counts as empty, so all NULL and empty texts are one group. Ids that are NULL come after all
    others; of rows with equal ids and texts exactly one is kept. No rows give no rows, and other
    columns aren't read, whatever their names. Whole texts are read; a text of any length is cut into
    chunks of at most 8 KB, so no row is longer than its text.

    Texts leave their scan once, as chunks, each at most once from every batch, combined before they shuffle.
    All else moves 16 bytes for every 1.5 KB of text: recipes are grouped with partial aggregation,
    so that a group with a third of all rows is one row per task, and joined back. Recipes of more than a
    thousandth of the rows, of which there are fewer than a thousand, are joined by broadcast if their
    bytes are counted to be few; no other recipe has more rows than that share.
    """
    recipes = verified_recipes(documents, chunk_hash)
    grouped = recipes.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "mark")).alias("best"), F.count("*").alias("group_size")
    )
    groups = saved(
        grouped.select("recipe", F.col("best.doc_id").alias("keep_id"), F.col("best.mark").alias("keep_mark"), "group_size"),
        "groups",
    )
    total = recipes.count()
    often = F.col("group_size") * SHARE > total
    heavy = groups.filter(often)
    held = heavy.agg(F.sum(F.length("recipe") + 64)).first()[0] or 0
    if held <= BROADCAST_BYTES:
        # The placement of a row is known before any shuffle: by the broadcast, or by the join of the rest.
        met = recipes.join(F.broadcast(heavy), "recipe", "left")
        found = met.filter(F.col("group_size").isNotNull())
        rest = met.filter(F.col("group_size").isNull()).select(*recipes.columns)
        met = found.unionByName(rest.join(groups.filter(~often), "recipe"))
    else:
        met = recipes.join(groups, "recipe")
    return met.select(
        "doc_id", "keep_id", "group_size", (F.col("mark") == F.col("keep_mark")).alias("kept"), "text_sha256"
    )


def remove_copies(documents: DataFrame, chunk_hash: Hash = _hash) -> DataFrame:
    """``documents`` without exact copies: of equal texts the row ``find_copies`` keeps stays.

    All columns stay. The rows to keep are found by id and the text's SHA-256; of rows that are equal in
    both, any one stays.
    """
    digest = F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)
    keys = ["doc_id", "text_sha256"]
    plan = saved(find_copies(documents, chunk_hash), "copies")
    kept = plan.filter("kept").select(*keys)
    repeated = saved(plan.groupBy(*keys).count().filter("count > 1").select(*keys), "repeated")
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("text_sha256"))
    kept = rows.join(kept, same_keys(rows, kept, keys), "left_semi")
    repeated = broadcast_if_small(repeated)
    single = kept.join(repeated, same_keys(kept, repeated, keys), "left_anti").select("row")
    several = kept.join(repeated, same_keys(kept, repeated, keys), "left_semi")
    one = several.groupBy(*keys).agg(F.any_value("row").alias("row")).select("row")
    return single.unionByName(one).select("row.*")
