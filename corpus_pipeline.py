"""The corpus pipeline: from raw documents to a mix of clean ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm import decontaminate, jaccard_join, line_dedup, mixing, quality_rules
from cartwright.llm.common import saved
from cartwright.llm.queries import SOURCE_WEIGHTS, table


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules (6): documents that they reject go.

    Of rows that share an id, all go if one is rejected; a row without an id stays. NULL and empty texts have
    no words and go, unless their id is NULL. No rows give no rows; all columns stay, whatever their names.
    """
    rejected = quality_rules.rate(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (4): repeated runs of lines leave the texts; ``n_chars`` follows.

    Every row stays, also one whose text is NULL, empty or gone after it. Rows equal in id and text are treated
    alike. No rows give no rows; all columns stay, whatever their names.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    # The other columns travel in one, so that none of their names meets one of the operator's.
    aside = F.struct(*(F.col(f"`{name}`") for name in others)) if others else F.struct(F.lit(0))
    cleaned = line_dedup.remove_repeated_lines(docs.select("doc_id", "text", aside.alias("others")))
    columns = [F.col(name) if name in ("doc_id", "text") else F.col(f"others.`{name}`") for name in docs.columns]
    cleaned = cleaned.select(*columns)
    if "n_chars" not in docs.columns:
        return cleaned
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.when(F.col("n_chars").isNotNull(), length)
    return cleaned.withColumn("n_chars", changed).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (8): one document of each group stays, by five words and 0.8.

    It's the one with the group's smallest id; a row without an id or without words stays. No rows give no
    rows; all columns stay, whatever their names.
    """
    linked = jaccard_join.link_documents(docs, shingle=5, percent=80)
    return jaccard_join.one_of_each(docs, linked)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (2): documents that contain a test item go.

    Rows that share an id go together, those without one as well. A text without words contains nothing and
    stays. No rows give no rows; all columns stay, whatever their names.
    """
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing (10): how often each remaining document is taken.

    This is a plan with one row per remaining document, those of no copies included, and without
    text: the mix itself is up to twice as large, and ``mixing.emit`` makes it from the documents
    and the plan where it is read. The pipeline's test asks for the plan's row count. A NULL text has size 0, a
    NULL source is a source, repeated rows count each; no rows give no rows; other columns aren't read.
    """
    return mixing.mix(docs, SOURCE_WEIGHTS)


STAGES = [
    ("quality rules", apply_quality_rules),
    ("line dedup", remove_repeated_lines),
    ("n-gram jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", remove_benchmark_leaks),
    ("mixing sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each but the last is written and read back as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


# The language model of the first stage can't be written in SQL.
ORACLE_SQL = None
