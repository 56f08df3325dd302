"""Modified Kneser-Ney over characters, counted and estimated by Spark for any number of languages."""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import broadcast_if_small, fresh_folder, opened, saved

ORDER = 4
#: Stands before a text, ORDER - 1 times.
PAD = "\0" * (ORDER - 1)
#: Entries of a model's block, and bytes of blocks that a task holds at a time.
BLOCK, HELD = 1 << 20, 256 << 20
#: Characters of a stretch of text, by whose median a text is judged.
STRETCH = 64
#: Characters are numbered with 16 bits inside a task, so that ORDER of them fit into 64. A task that
#: meets more than this many starts its numbers again.
LETTERS = 1 << 16


def language(lang: Column) -> Column:
    """A key that tells every language from every other and from NULL."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def windows(ids: np.ndarray) -> np.ndarray:
    """Runs of ORDER numbered characters as one number each."""
    size = len(ids) - ORDER + 1
    key = ids[:size].astype(np.uint64)
    for k in range(1, ORDER):
        key <<= np.uint64(16)
        key |= ids[k : k + size]
    return key


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


class _Counter:
    """Grams of one task by language, numbered over the characters met so far."""

    def __init__(self) -> None:
        self.ids = np.zeros(0x110000, dtype=np.uint16)
        self.known = np.zeros(0x110000, dtype=bool)
        self.letters = np.zeros(0, dtype=np.uint32)
        self.totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def fits(self, points: np.ndarray) -> bool:
        """Number the new characters, if the numbers suffice."""
        met = np.zeros(0x110000, dtype=bool)
        met[points] = True
        new = np.flatnonzero(met & ~self.known)
        if len(self.letters) + len(new) > LETTERS:
            return False
        self.ids[new] = np.arange(len(self.letters), len(self.letters) + len(new))
        self.known[new] = True
        self.letters = np.concatenate([self.letters, new.astype(np.uint32)])
        return True

    def add(self, lang: str, points: np.ndarray, starts: np.ndarray) -> None:
        """Every run that doesn't end in the characters before a text."""
        keys = windows(self.ids[points])
        ends = np.ones(len(keys), dtype=bool)
        # Texts start at ``starts``, each after ORDER - 1 characters that stand before it.
        for k in range(ORDER - 1):
            ends[starts[1:] - ORDER - k] = False
        keys = np.sort(keys[ends])
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        found = keys[at], np.diff(np.append(at, len(keys)))
        if lang in self.totals:
            found = _summed(*map(np.concatenate, zip(self.totals[lang], found)))
        self.totals[lang] = found

    def size(self) -> int:
        return sum(len(keys) for keys, _ in self.totals.values())

    def take(self) -> Iterator[pd.DataFrame]:
        for lang, (keys, counts) in self.totals.items():
            yield pd.DataFrame({"language": lang, "gram": _strings(keys, self.letters), "n": counts})
        self.__init__()


def _strings(keys: np.ndarray, letters: np.ndarray) -> list[str]:
    shifts = np.arange(16 * (ORDER - 1), -1, -16, dtype=np.uint64)
    numbers = (keys[:, None] >> shifts) & np.uint64(0xFFFF)
    whole = letters[numbers.astype(np.int64)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [whole[i : i + ORDER] for i in range(0, len(whole), ORDER)]


def _portions(texts: Iterator[str | None], most: int = 2_000_000) -> Iterator[list[str]]:
    """Texts that aren't empty, about ``most`` characters at a time."""
    held, size = [], 0
    for text in texts:
        if text:
            held.append(text)
            size += len(text)
        if size > most:
            yield held
            held, size = [], 0
    if held:
        yield held


def count_grams(documents: DataFrame) -> DataFrame:
    """(language, gram, n) over every character of every text.

    A task adds up its own counts before anything is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _Counter()
        for batch in batches:
            for lang, texts in batch.groupby("language")["text"]:
                for held in _portions(texts):
                    points = code_points("".join(PAD + text for text in held))
                    sizes = [len(text) + len(PAD) for text in held]
                    starts = np.cumsum([len(PAD), *sizes[:-1]])
                    if not counter.fits(points):
                        yield from counter.take()
                        if not counter.fits(points):
                            # More characters than numbers in one portion: one run at a time.
                            yield _one_by_one(lang, held)
                            continue
                    counter.add(lang, points, starts)
                    if counter.size() > 4_000_000:
                        yield from counter.take()
        yield from counter.take()

    counted = documents.select(language(F.col("lang")).alias("language"), "text").mapInPandas(
        run, "language string, gram string, n long"
    )
    return counted.groupBy("language", "gram").agg(F.sum("n").alias("n"))


def _one_by_one(lang: str, texts: list[str]) -> pd.DataFrame:
    grams = pd.Series([g for text in texts for g in text_grams(text)]).value_counts()
    return pd.DataFrame({"language": lang, "gram": grams.index, "n": grams.to_numpy()})


def text_grams(text: str) -> list[str]:
    padded = PAD + text
    return [padded[i : i + ORDER] for i in range(len(text))]


def _discount(d: int) -> Column:
    """What is taken off a count of d (3: or more), from the counts of counts n1 to n4."""
    n = [F.col(f"n{k}").cast("double") for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    found = d - (d + 1) * y * n[d] / n[d - 1]
    every = F.least(*n) > 0
    return F.when(every, F.least(F.greatest(found, F.lit(0.05)), F.lit(d - 0.05))).otherwise(0.5)


def backoff_model(counted: DataFrame) -> DataFrame:
    """(language, kind, gram, log2) of the saved counts.

    Of kind 1 to ORDER are the grams of that many characters that were met, with their interpolated
    probability; below zero the contexts of one to ORDER - 1 characters, with the weight that they leave to
    shorter ones; of kind 0 the probability of a character that was not met. The highest order has counts of
    occurrences, the lower ones of distinct preceding characters; below them all characters of the
    language are equally likely.
    """
    parts = [counted.select(F.lit(ORDER).alias("k"), "language", "gram", "n")]
    for k in range(ORDER - 1, 0, -1):
        shorter = parts[-1].groupBy("language", F.substring("gram", 2, k).alias("gram"))
        parts.append(shorter.agg(F.count("*").alias("n")).select(F.lit(k).alias("k"), "language", "gram", "n"))
    levels = parts[0]
    for part in parts[1:]:
        levels = levels.unionAll(part)
    levels = saved(levels, "levels")
    of_count = [F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]
    discounts = levels.groupBy("k", "language").agg(*of_count, F.count("*").alias("types"))
    discounts = discounts.select("k", "language", "types", *(_discount(d).alias(f"d{d}") for d in (1, 2, 3)))
    discounts = broadcast_if_small(saved(discounts, "discounts"))
    context = F.col("gram").substr(F.lit(1), F.col("k") - 1).alias("context")
    contexts = levels.groupBy("k", "language", context).agg(
        F.sum("n").alias("total"),
        F.count_if(F.col("n") == 1).alias("once"),
        F.count_if(F.col("n") == 2).alias("twice"),
        F.count_if(F.col("n") > 2).alias("often"),
    )
    left = F.col("once") * F.col("d1") + F.col("twice") * F.col("d2") + F.col("often") * F.col("d3")
    contexts = contexts.join(discounts, ["k", "language"]).withColumn("weight", left / F.col("total"))
    contexts = saved(contexts, "contexts")
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = levels.withColumn("context", context).join(contexts, ["k", "language", "context"])
    kept = ((F.col("n") - off) / F.col("total")).alias("kept")
    rows = saved(rows.select("k", "language", "gram", "types", "weight", kept), "kept")
    # What an order leaves, by context; the first order's context is empty, and what it leaves goes to all alike.
    alike = F.when(F.col("k") == 1, F.col("weight") / F.col("types")).otherwise(F.col("weight"))
    model = contexts.select("language", (1 - F.col("k")).alias("kind"), F.col("context").alias("gram"), F.log2(alike).alias("log2"))
    lower = None
    for k in range(1, ORDER + 1):
        own = rows.filter(F.col("k") == k)
        if lower is None:
            below = 1 / F.col("types")
        else:
            own = own.withColumn("suffix", F.substring("gram", 2, k - 1)).join(lower, ["language", "suffix"])
            below = F.col("p")
        p = F.col("kept") + F.col("weight") * below
        lower = saved(own.select("language", F.col("gram").alias("suffix"), p.alias("p")), "order")
        model = model.unionAll(lower.select("language", F.lit(k).alias("kind"), "suffix", F.log2("p").alias("log2")))
    return model


def estimate(counted: DataFrame) -> DataFrame:
    """(language, gram, log2) of the grams of ORDER characters in the saved counts."""
    return backoff_model(counted).filter(F.col("kind") == ORDER).select("language", "gram", "log2")


def hashed(columns: list[np.ndarray], kind: int, size: int) -> np.ndarray:
    """64-bit hashes of ``size`` strings of one kind, given by their first, second, ... characters."""
    mixer = np.uint64(0xD6E8FEB86659FD93)
    found = np.full(size, (kind + ORDER) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for column in columns:
        found ^= column.astype(np.uint64)
        found *= mixer
        found ^= found >> np.uint64(32)
    return found


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for kind, rows in batch.groupby("kind"):
            points = code_points("".join(rows["gram"])).reshape(len(rows), abs(kind))
            found = hashed([points[:, k] for k in range(abs(kind))], kind, len(rows))
            yield pd.DataFrame({"language": rows["language"], "hash": found.view(np.int64), "log2": rows["log2"]})


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows["hash"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    arrays = keys[order].tobytes(), rows["log2"].to_numpy()[order].tobytes()
    return pd.DataFrame([(rows["block"].iat[0], *arrays)], columns=["block", "keys", "log2"])


def write_arrays(model: DataFrame, block: int | None = None) -> str:
    """Write a model as sorted arrays of hashes, in blocks of about ``block`` entries, and return the folder.

    A block holds one language's hashes from a range, so that a lookup needs one block of one file. How many
    blocks a language has is a small table beside them. Nothing passes the driver.
    """
    spark, folder = model.sparkSession, fresh_folder(model.sparkSession, "arrays")
    model = saved(model, "model")
    blocks = F.ceil(F.count("*") / (block or BLOCK)).alias("blocks")
    model.groupBy("language").agg(blocks).write.parquet(f"{folder}/languages")
    counted = spark.read.parquet(f"{folder}/languages")
    rows = model.mapInPandas(_hashes, "language string, hash long, log2 double")
    rows = rows.join(broadcast_if_small(counted), "language")
    place = F.shiftright(F.shiftrightunsigned("hash", 32) * F.col("blocks"), 32)
    named = rows.select(F.concat(F.md5("language"), F.lit("-"), place).alias("block"), "hash", "log2")
    packed = named.groupBy("block").applyInPandas(_packed, "block string, keys binary, log2 binary")
    packed.write.partitionBy("block").parquet(f"{folder}/blocks")
    return folder


def middle_stretch(bits: np.ndarray) -> float:
    """The median, over stretches of about STRETCH characters, of their mean bits per character."""
    stretches = max(1, len(bits) // STRETCH)
    starts = np.arange(stretches) * len(bits) // stretches
    means = np.add.reduceat(bits, starts) / np.diff(np.append(starts, len(bits)))
    return float(np.median(means))


class Arrays:
    """A model's arrays, read block by block where they are needed."""

    def __init__(self, folder: str, held: int):
        self.folder, self.most = folder, held
        self.blocks: dict[str, int] = {}
        for file in opened(f"{folder}/languages"):
            table = pq.read_table(file)
            self.blocks |= zip(table["language"].to_pylist(), table["blocks"].to_pylist())
        self.held: OrderedDict[str, tuple[np.ndarray, np.ndarray]] = OrderedDict()
        self.size = 0

    def _block(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        if name in self.held:
            self.held.move_to_end(name)
            return self.held[name]
        keys = np.empty(0, np.uint64), np.empty(0)
        # A range without a hash has no file.
        for file in opened(f"{self.folder}/blocks/block={name}"):
            row = pq.ParquetFile(file).read().to_pylist()[0]
            keys = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["log2"])
        self.held[name] = keys
        self.size += 16 * len(keys[0])
        while self.size > self.most and len(self.held) > 1:
            _, (old, _) = self.held.popitem(last=False)
            self.size -= 16 * len(old)
        return keys

    def find(self, language: str, hashes: np.ndarray) -> np.ndarray:
        """The value of every hash, NaN where the model has none."""
        out = np.full(len(hashes), np.nan)
        n, high = np.uint64(self.blocks[language]), np.uint64(32)
        place = ((hashes >> high) * n) >> high
        name = hashlib.md5(language.encode()).hexdigest()
        for block in np.unique(place):
            keys, values = self._block(f"{name}-{block}")
            if len(keys):
                mine = np.flatnonzero(place == block)
                at = np.minimum(np.searchsorted(keys, hashes[mine]), len(keys) - 1)
                out[mine] = np.where(keys[at] == hashes[mine], values[at], np.nan)
        return out

    def log2(self, language: str, columns: list[np.ndarray]) -> np.ndarray:
        """The probability of the last of ORDER characters after the others, for many such runs.

        Where a run was not met, the weight that its context leaves and the shorter run's probability.
        """
        size = len(columns[0])
        out = self.find(language, hashed(columns, ORDER, size))
        left, weight = np.flatnonzero(np.isnan(out)), np.zeros(size)
        for k in range(ORDER - 1, -1, -1):
            if not len(left):
                break
            asked = [column[left] for column in columns]
            if k:
                found = self.find(language, hashed(asked[ORDER - 1 - k : ORDER - 1], -k, len(left)))
                weight[left] += np.nan_to_num(found)
            found = self.find(language, hashed(asked[ORDER - k :], k, len(left)))
            out[left] = weight[left] + found
            left = left[np.isnan(found)]
        return out

    def bits(self, language: str, texts: list[str | None]) -> list[float | None]:
        """Bits per character of every text; None for an empty one, 0 if the model has no such language.

        A token or a foreign passage in a good text doesn't decide: it's the text's middle stretch that counts.
        """
        if language not in self.blocks:
            return [0.0 if text else None for text in texts]
        out = []
        for held in _portions(iter(texts), 500_000):
            points = code_points("".join(PAD + text for text in held))
            sizes = np.array([len(text) for text in held])
            starts = np.cumsum(sizes) - sizes
            ends = np.arange(sizes.sum()) + np.repeat(np.arange(1, len(held) + 1) * len(PAD), sizes)
            columns = [points[ends - k] for k in range(ORDER - 1, -1, -1)]
            _, first, which = np.unique(hashed(columns, ORDER, len(ends)), return_index=True, return_inverse=True)
            known = self.log2(language, [column[first] for column in columns])
            out += [middle_stretch(-known[which[start : start + size]]) for start, size in zip(starts, sizes)]
        scored = iter(out)
        return [next(scored) if text else None for text in texts]
