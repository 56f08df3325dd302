"""Measures of one text, computed inside tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")

#: Words of a window whose repeats are counted.
WINDOW = 8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more in the text, the first one included.

    Windows are numbered exactly, from numbers of halves: no hash can collide.
    """
    if len(words) <= window:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    length = 1
    while length < window:
        pairs = ids[:-length] * (int(ids.max()) + 1) + ids[length:]
        _, ids = np.unique(pairs, return_inverse=True)
        length *= 2
    often = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[: len(often)] += often
    edges[window : window + len(often)] -= often
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


def base_measures(text: str | None) -> tuple[int, ...]:
    """In the order of BASE. NULL counts as empty."""
    text = text or ""
    words = _WORD.findall(text)
    return (
        len(words),
        sum(map(len, words)),
        len(_SYMBOL.findall(text)),
        repeated_lines(text) if "\n" in text else 0,
        repeated_words(words),
    )


def measured(
    documents: DataFrame, columns: list[str], measure: Callable[..., tuple], schema: str, names: list[str]
) -> DataFrame:
    """One row per document: ``doc_id`` and what ``measure`` makes of the named columns' values."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(row[0], *measure(*row[1:])) for row in batch.itertuples(index=False, name=None)]
            yield pd.DataFrame(rows, columns=["doc_id", *names])

    return documents.select("doc_id", *columns).mapInPandas(run, f"doc_id long, {schema}")
