"""From raw documents to a training mix, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next one's ``docs``, so a lost executor costs at most a stage.
All but the last return the columns of ``documents``.

1. toxicity: documents that score 0.5 or more go; learned from ``labels``.
2. near_duplicates: one document of each class of n-gram Jaccard 0.8 or more stays.
3. repeats: passages of ``PASSAGE`` bytes that occur twice go from the texts.
4. contamination: documents that share ten words in a row with ``benchmark`` go.
5. mixing: what is left is mixed by source weights; ``copies`` says how often a row is taken.

The stages run in one session, on executors that keep what they once took, so the batches of
texts that go to Python are bounded for all of them.

Null texts are empty documents and pass all filters; the mix takes no copy of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import contamination, jaccard, mixing, repeats, toxicity
from corpusloom.llm.language import fold_of
from corpusloom.session import bound_batches, stage


#: Fifty words of the shortest kind that texts here are made of; a shorter passage is a phrase.
PASSAGE = 250


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs, labels.filter(fold_of(F.col("doc_id"), 5) != 0))
    return toxicity.kept(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return jaccard.one_per_class(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return repeats.without_repeats(docs, length=PASSAGE)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return contamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("contamination", decontaminate),
    ("mixing", mix_sources),
]

#: The learned lexicon of the first stage cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
