"""A corpus from raw documents to tokens: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.batches import Scratch, fold, tucked
from touchline.llm.bpe import encode_and_decode
from touchline.llm.lines import dedup_lines
from touchline.llm.mixing import mix
from touchline.llm.neardup import near_duplicates
from touchline.llm.quality import fit_quality_model, score_quality
from touchline.llm.queries import VOCABULARY, domains, prepare, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Low quality is gone by then, so that only toxic and other documents are mixed.
TARGETS = {"clean": 0.95, "toxic": 0.05}

#: Columns of documents; a stage carries all others along.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

# No SQL: classifier, alignments and rates have no counterpart there.
ORACLE_SQL = None


def untouched(stage: Stage) -> Stage:
    """A stage that brings columns beyond those of documents through, whatever their names."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain, given = tucked(docs, DOCUMENT, "given")
        return stage(spark, plain, sf_dir).select(*given)

    return run


@untouched
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    It learns from labelled documents outside the fold that op6 holds out.
    """
    prepare(spark)
    part = fold("doc_id", 3)
    seen = (part >= 0) & (part != 1)
    labels = table(spark, sf_dir, "labels")
    model = fit_quality_model(docs.filter(seen), labels.filter(seen))
    return score_quality(docs, model, carried=True).filter("predicted = 1").select(*docs.columns)


@untouched
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of words; one left without a word goes."""
    prepare(spark)
    cleaned = dedup_lines(docs, Scratch(spark), removed="n_removed_lines", within=True)
    emptied = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"\S")
    return cleaned.filter(~emptied).select(*docs.columns)


@untouched
def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, with repeated rows once."""
    prepare(spark)
    found = near_duplicates(docs, Scratch(spark)).filter("kept")
    kept = found.select(F.col("doc_id").alias("kept_id"), F.col("content").alias("kept_content"))
    content = F.unhex(F.md5("text"))
    once = docs.dropDuplicates(["doc_id", "text"])
    return once.join(
        kept.distinct(),
        F.col("doc_id").eqNullSafe(F.col("kept_id")) & content.eqNullSafe(F.col("kept_content")),
        "left_semi",
    )


@untouched
def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate says."""
    prepare(spark)
    marks = domains(table(spark, sf_dir, "labels"))
    mixed = mix(docs, marks, TARGETS, Scratch(spark))
    copy = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.filter("copies > 0").withColumn("copy", copy).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and packed token ids of every document."""
    prepare(spark)
    path = public_tokenizers.path(VOCABULARY)
    kept = {"doc_id": "long", "lang": "string", "source": "string"}
    encoded = encode_and_decode(docs.withColumn("text", F.coalesce("text", F.lit(""))), path, kept)
    return encoded.select(*kept, "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", keep_one_of_each),
    ("mixing to target weights", mix_domains),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    scratch = Scratch(prepare(spark))
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
