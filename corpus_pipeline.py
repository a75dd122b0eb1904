"""A corpus pipeline: language, near duplicates, benchmark leaks, mix, token files.

Each stage takes the documents its predecessor kept and decides on all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import decontaminate, jaccard, langid, mixing, token_store
from barlake.llm.queries import tokenizer_path, with_quality
from barlake.llm.text import small_batches
from barlake.session import scratch_dir

#: Begins the names of what stages add for themselves, so that columns of the documents may have any other name.
OWN = "_stage_"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def columns_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that belong to a learned language; the others go."""
    small_batches(spark)
    model = langid.fit(langid.learning_rows(docs))
    found = langid.identify(docs, model, prefix=OWN).filter(~F.col(f"{OWN}rejected"))
    return columns_of(docs, found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    # Null ids are a key like any other. The join deals by the key that repeated rows share, so they meet there without a shuffle more.
    names = [f"{OWN}{n}" for n in ("id", "none", "tie")]
    key = lambda tie: (F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.col("doc_id").isNull(), tie)
    kept = jaccard.similar_documents(docs).filter("keeper").select(*(c.alias(n) for c, n in zip(key(F.col("tie")), names))).distinct()
    keyed = docs.withColumns(dict(zip(names, key(F.xxhash64(F.col("text").cast("string"))))))
    return columns_of(docs, keyed.join(kept, names, "left_semi").dropDuplicates(names))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.decontaminate(docs, items, column=f"{OWN}leak")
    return columns_of(docs, found.filter(F.col(f"{OWN}leak")["n_hit"] == 0))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    rows = with_quality(mixing.measured(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed_rows = mixing.taken_up(docs, mixing.draw(rows, "quality"), prefix=OWN)
    return columns_of(docs, mixing.materialise(mixed_rows, prefix=OWN))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, and where each document is in them."""
    store = scratch_dir(spark, "corpus-tokens")
    token_store.write_token_store(docs, store, tokenizer_path())
    return token_store.read_token_store(spark, store, keep_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed),
    ("token_files", token_files),
]

# The first stage is a trained model and the last a tokenizer: SQL cannot say either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
