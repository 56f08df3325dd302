"""Fill-in-middle transformation by rotating blocks in place, and its exact inverse."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN, PSM, SPM = "plain", "psm", "spm"
MADE = "n long, form string, prefix_chars long, middle_chars long, output binary"


@dataclass(frozen=True)
class FillMiddle:
    """How often texts are transformed, into which form, and with which sentinels.

    ``rate`` percent of the texts are transformed, ``spm_rate`` percent of these with the suffix
    first. ``seed`` is hashed with the document's id, so that a rerun gives the same.
    """

    seed: int = 7
    rate: int = 100
    spm_rate: int = 50
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self) -> None:
        marks = self.prefix, self.suffix, self.middle
        starts = {mark[:1] for mark in marks}
        if len(set(marks)) < 3 or b"" in marks or any(s in mark[1:] for mark in marks for s in starts):
            # Else a piece of text and the sentinel beside it could be read as another sentinel.
            raise ValueError("sentinels differ, and what one starts with stands nowhere else in them")


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from the seed and the id; no id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


def _reverse(buffer: bytearray, start: int, end: int) -> None:
    buffer[start:end] = buffer[start:end][::-1]


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the neighbours ``buffer[start:cut]`` and ``buffer[cut:end]`` by three reversals."""
    _reverse(buffer, start, cut)
    _reverse(buffer, cut, end)
    _reverse(buffer, start, end)


def _characters(text: bytes) -> int:
    """Code points of UTF-8: bytes that continue none."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def transform(text: bytes, doc_id: int | None, how: FillMiddle) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    if text and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    n = len(ends)
    h1, h2, h3, h4 = draws(how.seed, doc_id)
    marks = how.prefix, how.suffix, how.middle
    if not text or h3 % 100 >= how.rate or any(mark in text for mark in marks):
        return n, PLAIN, None, None, text
    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    sizes = _characters(text[:first]), _characters(text[first:second])
    buffer = bytearray(text)
    # From the back, so that the cuts before stay where they are.
    buffer[second:second] = how.suffix
    buffer[first:first] = how.middle
    buffer[0:0] = how.prefix
    middle_at = len(how.prefix) + first
    suffix_at = len(how.prefix) + len(how.middle) + second
    form = SPM if h4 % 100 < how.spm_rate else PSM
    rotate(buffer, 0 if form == SPM else middle_at, suffix_at, len(buffer))
    return n, form, *sizes, bytes(buffer)


def restore(output: bytes, form: str, how: FillMiddle) -> bytes:
    """The text that ``transform`` was given."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    if form == SPM:
        start, cut = 0, buffer.index(how.prefix)
    else:
        start = buffer.index(how.suffix)
        cut = buffer.index(how.middle, start)
    # What was exchanged is exchanged back: the block behind the cut comes first again.
    rotate(buffer, start, cut, len(buffer))
    suffix_at = start + len(output) - cut
    middle_at = start if form == PSM else buffer.index(how.middle)
    del buffer[suffix_at : suffix_at + len(how.suffix)]
    del buffer[middle_at : middle_at + len(how.middle)]
    del buffer[: len(how.prefix)]
    return bytes(buffer)


def _transforming(how: FillMiddle) -> Callable:
    def made(doc_ids: pa.Array, texts: pa.Array) -> pa.Array:
        rows = [transform(text.as_py() or b"", doc_id.as_py(), how) for doc_id, text in zip(doc_ids, texts)]
        columns = list(zip(*rows)) or [()] * 5
        kinds = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()
        names = [field.split()[0] for field in MADE.split(", ")]
        return pa.StructArray.from_arrays(list(map(pa.array, columns, kinds)), names)

    return F.arrow_udf(made, MADE)


def _restoring(how: FillMiddle) -> Callable:
    def restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        rows = (restore(output.as_py() or b"", form.as_py() or PLAIN, how) for output, form in zip(outputs, forms))
        return pa.array(list(rows), pa.binary())

    return F.arrow_udf(restored, "binary")


def fill_in_middle(documents: DataFrame, how: FillMiddle = FillMiddle()) -> DataFrame:
    """Cut every text of ``documents`` at two line ends and put the middle last, behind sentinels.

    Adds one struct ``fill_middle`` (n, form, prefix_chars, middle_chars, output) to the columns of
    ``documents``; a column of that name is replaced, others may have any names. ``n`` counts the lines,
    ``form`` is ``plain``, ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle),
    ``output`` is the text as it is trained on.

    A NULL or empty text and one that holds a sentinel stay plain: the output is the text, NULL as
    empty, and both counts are NULL. A row without an id draws as for an empty id; rows with equal
    ids and texts give equal outputs. No rows give no rows. Whole texts are worked on, one at a time,
    whatever their length: memory is a few times that of an Arrow batch or of one text.

    There is no shuffle, and the cuts come from the seed and the id, so a task that is run again
    after a lost executor gives the same rows.
    """
    made = _transforming(how)(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    rows = documents.select(F.struct("*").alias("row"), made.alias("made"))
    kept = [F.col(f"row.`{name}`") for name in documents.columns if name != "fill_middle"]
    fields = [F.col(f"made.{name}") for name in ("n", "form", "prefix_chars", "middle_chars")]
    output = F.col("made.output").cast("string").alias("output")
    return rows.select(*kept, F.struct(*fields, output).alias("fill_middle"))


def restored(output: Column, form: Column, how: FillMiddle = FillMiddle()) -> Column:
    """The exact text from an output and its form; a NULL output gives an empty text."""
    return _restoring(how)(output.cast("binary"), form).cast("string")
