"""N-gram Jaccard join: exact candidate groups, joined by signature trees."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, only, saved
from cartwright.llm.components import components

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

#: Neighbouring size classes differ by this factor.
STEP = 1.25
#: Spare parts for every part that may differ.
SPARE = 0.5
#: Documents under one node at the lowest level of a tree.
LEAF = 64
#: The holders of a key are checked against each other by their sketches; beyond this many they all stay
#: candidates of each other.
CHECKED = 512


def _mix(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers (the finaliser of splitmix64, whose constants these are)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, shingle: int = 3) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles, A-Z lower-cased; of all words if fewer."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    rolled = hashes[: len(words) - shingle + 1]
    for k in range(1, shingle):
        rolled = _mix(rolled) + hashes[k : k + len(rolled)]
    return np.unique(_mix(rolled))


def _size_class(size: int) -> int:
    k = int(math.log(size) / math.log(STEP))
    while STEP ** (k + 1) <= size:
        k += 1
    while STEP**k > size:
        k -= 1
    return k


def part_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of which any two different linked sets share at least one.

    In a class of sets of at most u shingles, linked sets differ in no more than
    d = 2u(100 - percent) / (100 + percent) of them. Hash the shingles into more than d parts, and
    some part is equal. A set has the keys of its own class and of those of the larger sets
    it may link with. Unrelated sets may share small parts by chance, so a set leaves out the parts of
    fewer than t shingles, for the largest t that leaves out no more than there are spare parts. Two
    linked sets have more equal parts than spare ones, and what is left out of the equal parts is what
    the set with the larger t leaves out: some equal part remains.
    """
    size = len(hashes)
    if not size:
        return hashes
    found = []
    for k in range(_size_class(size), _size_class(size * 100 // percent) + 1):
        limit = math.ceil(STEP ** (k + 1)) - 1
        differing = 2 * limit * (100 - percent) // (100 + percent)
        if not differing:
            continue
        spare = max(2, math.ceil(SPARE * differing))
        n = differing + 1 + spare
        part = ((hashes >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        counts = np.bincount(part, minlength=n)
        ends = np.cumsum(counts)
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(hashes[order]), dtype=np.uint64)])
        total = running[ends] - running[ends - counts]
        keys = _mix(_mix(total + np.uint64(k)) + np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        # The smallest part that must stay sets the threshold.
        found.append(keys[counts >= np.partition(counts, spare)[spare]])
    return np.concatenate(found) if found else hashes[:0]


class _Nodes:
    """One level of a tree: OR-combined bitmaps and size ranges of runs of documents."""

    def __init__(self, bitmaps: np.ndarray, low: np.ndarray, high: np.ndarray, most: np.ndarray):
        self.bitmaps, self.low, self.high, self.most = bitmaps, low, high, most

    def above(self, fan: int) -> _Nodes:
        starts = np.arange(0, len(self.low), fan)
        return _Nodes(
            np.bitwise_or.reduceat(self.bitmaps, starts),
            np.minimum.reduceat(self.low, starts),
            np.maximum.reduceat(self.high, starts),
            np.maximum.reduceat(self.most, starts),
        )

    def may_link(self, i: int, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether some document below node i may link with some below each node of j.

        No pair overlaps by more than the smaller of its largest sizes, nor by more than the common
        bits of the nodes times the most shingles that one document has in a bit.
        """
        common = np.bitwise_count(self.bitmaps[i] & self.bitmaps[j]).sum(axis=1)
        most = np.minimum(self.most[i], self.most[j])
        overlap = np.minimum(np.minimum(self.high[i], self.high[j]), common * most)
        return overlap * 100 >= percent * np.maximum(self.low[i], self.low[j])


def join_sets(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the first member of its component of links: a union-find after a tree self-join.

    The sets, in order of size, are the leaves of a tree. A dual traversal from the root leaves out node
    pairs that can't hold a link. At the leaves, a set's bits that another lacks are shingles
    it lacks; pairs that survive and aren't connected yet are intersected exactly.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:1].tolist()))
    ranked = [sets[i] for i in order]
    sizes = np.array([len(s) for s in ranked], dtype=np.int64)
    bits = 1 << min(16, max(8, int(8 * sizes.max() - 1).bit_length()))
    bitmaps = np.zeros((len(sets), bits // 64), dtype=np.uint64)
    most = np.empty(len(sets), dtype=np.int64)
    for row, hashes in enumerate(ranked):
        spread = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits)
        most[row] = spread.max()
        bitmaps[row] = np.packbits(spread > 0).view(np.uint64)
    levels = [_Nodes(bitmaps, sizes, sizes, most).above(LEAF)]
    while len(levels[-1].low) > 1:
        levels.append(levels[-1].above(4))
    root = np.arange(len(sets))

    def find(ranks: np.ndarray) -> np.ndarray:
        """The roots of some sets, which then point straight at them."""
        found = root[ranks]
        while np.any(found != (above := root[found])):
            found = above
        root[ranks] = found
        return found

    def compare(i: int, others: np.ndarray) -> None:
        """Link set i with those of ``others``, which stand before it and are no larger."""
        others = others[find(others) != find(np.array([i]))]
        lacking = np.bitwise_count(bitmaps[others] & ~bitmaps[i]).sum(axis=1)
        overlap = sizes[others] - lacking
        needed = percent * (sizes[i] + sizes[others])
        for j in others[overlap * (100 + percent) >= needed].tolist():
            a, b = find(np.array([i, j])).tolist()
            if a != b:
                common = len(np.intersect1d(ranked[i], ranked[j], assume_unique=True))
                if 100 * common >= percent * (sizes[i] + sizes[j] - common):
                    root[max(a, b)] = min(a, b)

    pairs = [(len(levels) - 1, 0, 0)]
    while pairs:
        level, i, j = pairs.pop()
        if level:
            below = levels[level - 1]
            first = np.arange(4 * i, min(4 * i + 4, len(below.low)))
            second = np.arange(4 * j, min(4 * j + 4, len(below.low)))
            for a in first.tolist():
                later = second[second <= a]
                pairs += [(level - 1, a, b) for b in later[below.may_link(a, later, percent)].tolist()]
            continue
        # Nothing is left to find between leaves of one component, as among thousands of near copies.
        met = np.r_[LEAF * j : min(LEAF * j + LEAF, len(sets)), LEAF * i : min(LEAF * i + LEAF, len(sets))]
        if np.ptp(find(met)) == 0:
            continue
        for a in range(LEAF * i, min(LEAF * i + LEAF, len(sets))):
            others = np.arange(LEAF * j, min(LEAF * j + LEAF, a))
            others = others[100 * sizes[others] >= percent * sizes[a]]
            if len(others):
                compare(a, others)
    label = [0] * len(sets)
    for i, first in zip(order, find(np.arange(len(sets))).tolist()):
        label[i] = order[first]
    return label


def sketch(hashes: np.ndarray) -> bytes:
    """A bitmap of a set, of at least two bits a shingle and a power of two of bits."""
    bits = 1 << max(6, int(2 * len(hashes) - 1).bit_length())
    marked = np.zeros(bits, dtype=np.uint8)
    marked[(hashes % np.uint64(bits)).astype(np.int64)] = 1
    return np.packbits(marked, bitorder="little").tobytes()


def connect(rows: list[tuple[int, int, bytes]], percent: int) -> set[tuple[int, int]]:
    """Edges that connect those of some sets, given as id, size and sketch, which may link.

    Sets that do link are always connected: a bit that only one of two sets has stands for a shingle at
    least that the other lacks. Sketches of different widths are compared at the smaller one.
    """
    ids = [row[0] for row in rows]
    sizes = np.array([row[1] for row in rows], dtype=np.int64)
    maps = [np.frombuffer(row[2], dtype="<u8") for row in rows]
    widths = np.array([len(m) for m in maps])
    root, edges = np.arange(len(rows)), set()
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        wider = np.flatnonzero((widths > width) & (percent * sizes <= 100 * sizes[own].max()))
        met = np.append(own, wider)
        marks = np.stack([np.bitwise_or.reduce(maps[k].reshape(-1, width)) for k in met.tolist()])
        marked = np.bitwise_count(marks).sum(axis=1).astype(np.int64)
        hidden = sizes[met] - marked
        for at, i in enumerate(own.tolist()):
            rest = at + 1 + np.flatnonzero(root[met[at + 1 :]] != root[i])
            n = sizes[met[rest]]
            near = 100 * np.minimum(n, sizes[i]) >= percent * np.maximum(n, sizes[i])
            rest, n = rest[near], n[near]
            common = np.bitwise_count(marks[rest] & marks[at]).sum(axis=1).astype(np.int64)
            overlap = np.minimum(hidden[rest], hidden[at]) + common
            found = met[rest[overlap * (100 + percent) >= percent * (n + sizes[i])]]
            joined, first = np.unique(root[found], return_index=True)
            edges |= {(max(ids[i], ids[k]), min(ids[i], ids[k])) for k in found[first].tolist()}
            root[np.isin(root, joined)] = root[i]
    return edges


def may_link(one: tuple[int, bytes], two: tuple[int, bytes], percent: int) -> bool:
    """Whether two sets, given as size and sketch, may link; never False for sets that do."""
    return bool(connect([(0, *one), (1, *two)], percent))


def _holders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by key and id: the ids of each key that has several.

    At most ``CHECKED`` ids come as one list, to be checked. A key with more of them gives unchecked
    pairs, of its first holder with each later one. No more than a batch and ``CHECKED`` ids are held.
    """
    key, held, wide = None, np.empty(0, np.int64), False
    for batch in batches:
        keys, ids = batch["key"].to_numpy(), batch["doc_id"].to_numpy()
        if len(held):
            keys, ids = np.append(np.full(len(held), key), keys), np.append(held, ids)
        begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        ends = np.append(begins[1:], len(keys))
        several, pairs = set(), set()
        for run in np.flatnonzero(ends - begins > 1).tolist():
            found = np.unique(ids[begins[run] : ends[run]])
            if len(found) > CHECKED or (wide and not run):
                pairs |= {(int(found[0]), other) for other in found[1:].tolist()}
            elif len(found) > 1 and run < len(begins) - 1:
                several.add(tuple(found.tolist()))
        key, rest = keys[-1], np.unique(ids[begins[-1] :])
        wide = len(rest) > CHECKED or (wide and len(begins) == 1)
        held = rest[:1] if wide else rest
        yield _listed(several, pairs)
    if len(held) > 1:
        yield _listed({tuple(held.tolist())}, set())


def _listed(several: set[tuple], pairs: set[tuple]) -> pd.DataFrame:
    ids = [list(x) for x in several] + [list(x) for x in pairs]
    check = [True] * len(several) + [False] * len(pairs)
    # Typed, as Arrow refuses an empty column of floats for lists.
    return pd.DataFrame({"ids": pd.Series(ids, dtype=object), "check": pd.Series(check, dtype=bool)})


def _check(percent: int):
    """Of rows sorted by holder list: edges that connect those holders which may link."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, rows = None, []
        for batch in batches:
            found = set()
            for holders, *row in batch.itertuples(index=False, name=None):
                if holders != last:
                    found |= connect(rows, percent)
                    last, rows = holders, []
                rows.append(tuple(row))
            yield pd.DataFrame(sorted(found), columns=["doc_id", "rep"])
        yield pd.DataFrame(sorted(connect(rows, percent)), columns=["doc_id", "rep"])

    return run


def link_documents(
    documents: DataFrame,
    shingle: int = 3,
    percent: int = 90,
    block_shingles: int = 4_000_000,
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` or more.

    A text's set is that of its distinct runs of ``shingle`` words, A-Z lower-cased; all words if there
    are fewer; empty without words. Returns doc_id, n_shingles, component_id (the smallest doc_id
    reachable by links), one row per input row. Documents with empty sets, NULL text included, are
    linked with nothing; rows that share an id share a component; a NULL id has no links and no
    component. An empty table gives no rows; other columns don't matter.

    Equal sets are linked first, by a 128-bit hash and aggregation. The smallest id of each then stands
    for them. Sets that may link share a key (see ``part_keys``: no link is lost); the keys are
    shuffled once and sorted, and the holders of each that may link by their sketches are connected.
    The components of that graph are the groups in which links can be. A group is joined by a signature tree in one task, and one of more than
    ``block_shingles`` shingles is cut into blocks, every two of which meet in a task of their own.
    A task hands on at most one edge per set.
    """

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in batch.itertuples(index=False, name=None):
                hashes = shingle_set(text, shingle)
                digest = xxhash.xxh3_128_digest(hashes.tobytes())
                high, low = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                rows.append((doc_id, len(hashes), high, low, sketch(hashes)))
            frame = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "high", "low", "sketch"])
            yield frame.astype({"doc_id": "Int64"})

    def list_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in np.array_split(np.arange(len(batch)), max(1, len(batch) // 500)):
                part = batch.iloc[some]
                keys = [part_keys(shingle_set(text, shingle), percent) for text in part["text"]]
                ids = np.repeat(part["doc_id"].to_numpy(np.int64), [len(k) for k in keys])
                if len(ids):
                    yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "doc_id": ids})

    described = saved(
        documents.select("doc_id", "text").mapInPandas(
            describe, "doc_id long, n_shingles long, high long, low long, sketch binary"
        ),
        "sets",
    )
    known = described.filter("doc_id IS NOT NULL AND n_shingles > 0")
    digest = ["high", "low", "n_shingles"]
    least = known.groupBy(*digest).agg(F.min("doc_id").alias("rep"))
    members = saved(known.select("doc_id", *digest).join(least, digest), "members")
    copies = saved(members.filter("doc_id <> rep").select("doc_id", "rep"), "copies")
    standing = members.filter("doc_id = rep").select("doc_id", "n_shingles").distinct()

    single = documents.select("doc_id", "text").filter("doc_id IS NOT NULL")
    single = single.join(broadcast_if_small(copies.select("doc_id").distinct()), "doc_id", "left_anti")
    holders = (
        single.mapInPandas(list_keys, "key long, doc_id long")
        .repartition("key")
        .sortWithinPartitions("key", "doc_id")
        .mapInPandas(_holders, "ids array<long>, check boolean")
    )
    holders = saved(holders.distinct(), "holders")
    listed = holders.filter("check").select(
        F.xxhash64("ids").alias("holders"), F.explode("ids").alias("doc_id")
    )
    checked = (
        listed.join(known.select("doc_id", "n_shingles", "sketch"), "doc_id")
        .select("holders", "doc_id", "n_shingles", "sketch")
        .repartition("holders")
        .sortWithinPartitions("holders")
        .mapInPandas(_check(percent), "doc_id long, rep long")
    )
    unchecked = holders.filter("NOT check").select(
        F.col("ids")[1].alias("doc_id"), F.col("ids")[0].alias("rep")
    )
    near = saved(checked.union(unchecked).distinct(), "near")
    grouped = components(near, "doc_id", "rep").withColumnRenamed("component", "group")
    grouped = grouped.join(standing, grouped.node == standing.doc_id)
    grouped = saved(grouped.select("doc_id", "group", "n_shingles"), "groups")

    linked = _join_groups(documents, grouped, shingle, percent, block_shingles)
    found = components(copies.union(linked), "doc_id", "rep")
    rows = described.select("doc_id", "n_shingles")
    return rows.join(found, rows.doc_id == found.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def _join_groups(
    documents: DataFrame, grouped: DataFrame, shingle: int, percent: int, block_shingles: int
) -> DataFrame:
    """(doc_id, rep): edges that connect the components of links inside every group."""
    blocks = grouped.groupBy("group").agg(
        F.ceil(F.sum("n_shingles") / block_shingles).cast("int").alias("blocks")
    )
    placed = saved(grouped.distinct().join(blocks, "group").drop("n_shingles"), "blocks")

    def list_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["hashes"] = [shingle_set(text, shingle).tobytes() for text in batch["text"]]
            yield batch[["doc_id", "group", "blocks", "hashes"]]

    texts = only(documents.select("doc_id", "text"), placed, ["doc_id"]).join(placed, "doc_id")
    sets = texts.mapInPandas(list_sets, "doc_id long, group long, blocks int, hashes binary")
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    met = sets.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    met = met.withColumns({"one": F.least("own", "other"), "two": F.greatest("own", "other")})

    def join(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["doc_id"].tolist()
        label = join_sets([np.frombuffer(h, dtype=np.uint64) for h in group["hashes"]], percent)
        edges = [(ids[i], ids[k]) for i, k in enumerate(label) if ids[i] != ids[k]]
        return pd.DataFrame(edges, columns=["doc_id", "rep"])

    met = met.select("group", "one", "two", "doc_id", "hashes")
    return met.groupBy("group", "one", "two").applyInPandas(join, "doc_id long, rep long")


def one_of_each(documents: DataFrame, linked: DataFrame) -> DataFrame:
    """The documents that stand for their component: the one whose id is smallest; all with a NULL id."""
    others = linked.filter("doc_id <> component_id").select("doc_id").distinct()
    return documents.join(others, "doc_id", "left_anti")
