"""The pipeline, stage by stage, against brute force over whole tables."""

import corpus_pipeline
import pyarrow as pa
import pytest
from helpers import contamination, jaccard_classes, kept_bytes, mixed
from pyspark.sql import functions as F

from corpusloom.llm import contamination as decontamination
from corpusloom.llm import jaccard, repeats, toxicity
from corpusloom.llm.language import fold_of
from corpusloom.session import BATCH_BYTES, bound_batches, stage

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").filter(fold_of(F.col("doc_id"), 5) != 0)
    model = toxicity.learn(docs, labels)

    def toxic(rows):
        return {i: t for i, t in rows.items() if model.score(t) < 0.5}

    def near(rows):
        ids = sorted(rows)
        classes, _ = jaccard_classes([rows[i] for i in ids])
        return {ids[c]: rows[ids[c]] for c in classes}

    def cut(rows):
        left = kept_bytes(rows.values(), corpus_pipeline.PASSAGE)
        return {i: b.decode("utf-8", "ignore") for i, b in zip(rows, left, strict=True)}

    def clean(rows):
        return {i: t for i, t in rows.items() if not contamination(t, items)[1]}

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "contamination", "mixing"]
    for (_, function), slow in zip(corpus_pipeline.STAGES, (toxic, near, cut, clean), strict=False):
        docs = stage(function(spark, docs, FOLDER), "test")
        rows = slow(rows)
        assert docs.columns == columns
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == rows
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())

    taken = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()}
    targets, _ = mixed([(sources[i], t) for i, t in rows.items()])
    words = dict.fromkeys(targets, 0)
    for i, r in taken.items():
        assert r["text"] == rows[i] and 1 <= r["copies"] <= 3
        words[sources[i]] += len(rows[i].split()) * r["copies"]
    longest = {s: max(len(t.split()) for i, t in rows.items() if sources[i] == s) for s in targets}
    assert all(abs(words[s] - targets[s]) <= longest[s] for s in targets)


def test_run_is_the_stages_one_after_the_other(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    again = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copies"]


@pytest.fixture
def batch_limit(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    yield name
    spark.conf.unset(name)


@pytest.mark.parametrize(
    ("stage_name", "module", "operator"),
    [
        ("toxicity", toxicity, "kept"),
        ("near_duplicates", jaccard, "one_per_class"),
        ("repeats", repeats, "without_repeats"),
        ("contamination", decontamination, "decontaminated"),
    ],
)
def test_stages_bound_the_batches_of_their_texts(spark, monkeypatch, batch_limit, stage_name, module, operator):
    """20 MB of texts in one partition come in batches of BATCH_BYTES and at most a text more, all of them."""
    size, n = 100_000, 200

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([len(batch)])], ["bytes", "rows"])

    docs = spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.expr(f"repeat('a', {size})").alias("text"))
    monkeypatch.setattr(module, operator, lambda docs, *args, **options: docs.mapInArrow(sizes, "bytes bigint, rows bigint"))
    monkeypatch.setattr(toxicity, "learn", lambda *args: None)
    found = dict(corpus_pipeline.STAGES)[stage_name](spark, docs, FOLDER).collect()
    assert sum(r["rows"] for r in found) == n
    assert max(r["bytes"] for r in found) <= BATCH_BYTES + 2 * size


@pytest.mark.parametrize(("before", "after"), [("1m", "1m"), ("4194304", "4194304"), ("64mb", str(BATCH_BYTES))])
def test_a_lower_limit_of_the_session_stays(spark, batch_limit, before, after):
    spark.conf.set(batch_limit, before)
    bound_batches(spark)
    assert spark.conf.get(batch_limit) == after
