"""A corpus pipeline of five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir) and works on every row its predecessor kept; all
but the last return the columns of ``docs``.  Between stages the rows are written as Parquet in the
shared folder and read again, which cuts lineage: a lost executor repeats tasks of one stage only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import common as C
from larder.llm import jaccard_join, mixing, packing, pii, toxicity
from larder.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; NULL and empty texts score like any."""
    params = toxicity.ToxicityParams()
    model = toxicity.fit(docs, C.read(spark, sf_dir, "labels", "doc_id", "toxic"), params)
    return toxicity.score(docs, model, name="_toxicity").where(F.col("_toxicity") < params.threshold).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word shingles link at 75 % or more."""
    return jaccard_join.one_of_each(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data in its text replaced by the kind."""
    out = pii.redacted(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of the tree of domain, language and source ask."""
    return mixing.select_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a token sequence."""
    return packing.best_fit_packing(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Scores of a fitted model and message passing have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    C.ship(spark)
    scratch = C.Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
