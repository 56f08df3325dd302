"""Quality rules: base rules and perplexity bands of a Kneser-Ney model counted by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm import char_model
from cartwright.llm.char_model import Arrays, backoff_model, count_grams, language, write_arrays
from cartwright.llm.common import broadcast_if_small, saved
from cartwright.llm.text_measures import BASE, base_measures

def rate(
    documents: DataFrame,
    min_words: int = 20,
    most_repeated: int = 30,
    below: float = 6.0,
    above: float = 6.0,
) -> DataFrame:
    """Base measures of every document and whether it is kept.

    A text fails the base rules with fewer than ``min_words`` words or with more than
    ``most_repeated`` percent of its words in repeated windows of eight. The others are judged by a
    modified Kneser-Ney model over four characters (code points), counted over the texts of their
    language, by its value: bits per character (the median over stretches of about 64 characters) more than ``below`` or ``above`` times the median
    absolute deviation away from the language's median, on the lower or upper side, reject a document;
    both limits are the same. Short texts scatter more, so their bands are wider by
    sqrt(1 + 400 / characters). The deviation counts as 0.02 bits at least.

    Returns doc_id, the measures of BASE, base_failed, bits (NULL for an empty text) and kept; one row
    per input row. NULL and empty texts have no words and fail; a NULL language is a language; an
    empty table gives no rows; other columns don't matter.

    No text is judged by a model that it was counted in: the texts fall into two halves by a hash, and
    each half is judged by the model of the other, so that equal texts don't speak for each other either. A
    language that has texts in one half alone isn't judged; its texts have 0 bits.

    Counts, discounts and probabilities are Spark tables at every size, of one order. The models are
    written as sorted arrays of 64-bit hashes, in blocks, which tasks read as they need them, holding a
    bounded number. Medians are sketches.
    """
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    of_half = lambda h: F.concat(h.cast("string"), language(F.col("lang")))
    counted = count_grams(documents.select("text", of_half(half).alias("lang")))
    folder = write_arrays(backoff_model(saved(counted, "grams")))
    held = char_model.HELD

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        arrays = Arrays(folder, held)
        for batch in batches:
            bits: dict[int, float | None] = {}
            for model, rows in batch.groupby("model"):
                bits |= zip(rows.index, arrays.bits(model, rows["text"].tolist()))
            rows = [
                (None if row.id is None else int(row.id), *base_measures(row.text), row.language, len(row.text or ""), bits[row.Index])
                for row in batch.itertuples()
            ]
            out = pd.DataFrame(rows, columns=["doc_id", *BASE, "language", "chars", "bits"])
            yield out.astype({"doc_id": "Int64", "bits": "Float64"})

    asked = documents.select(
        # As text, so that a batch with NULLs keeps large ids exact.
        F.col("doc_id").cast("string").alias("id"),
        "text",
        language(F.col("lang")).alias("language"),
        language(of_half(1 - half)).alias("model"),
    )
    names = ", ".join(f"{name} long" for name in BASE)
    rated = asked.mapInPandas(measure, f"doc_id long, {names}, language string, chars long, bits double")
    rated = saved(
        rated.withColumn(
            "base_failed",
            (F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words")),
        ),
        "rated",
    )
    fit_for = rated.filter("NOT base_failed AND bits IS NOT NULL")
    middle = fit_for.groupBy("language").agg(F.percentile_approx("bits", 0.5, 1000).alias("middle"))
    middle = broadcast_if_small(saved(middle, "medians"))
    off = F.abs(F.col("bits") - F.col("middle"))
    spread = (
        fit_for.join(middle, "language")
        .groupBy("language", "middle")
        .agg(F.greatest(F.percentile_approx(off, 0.5, 1000), F.lit(0.02)).alias("spread"))
    )
    spread = broadcast_if_small(saved(spread, "bands"))
    scatter = F.col("spread") * F.sqrt(1 + 400 / F.greatest("chars", F.lit(1)))
    distance = F.col("bits") - F.col("middle")
    judged = rated.join(spread, "language", "left")
    inside = F.coalesce(distance.between(-below * scatter, above * scatter), F.lit(False))
    return judged.select(
        "doc_id", *BASE, "base_failed", "bits", (~F.col("base_failed") & inside).alias("kept")
    )
