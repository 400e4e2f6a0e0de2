"""Forms that keep work and memory in proportion to the input, against plain ones."""

from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from corpusloom.functions.text import pieces
from corpusloom.operators import bpe, generate, language_model as lm, lookup, metrics, rowfile, tokenize, vocabulary
from corpusloom.operators import stream as st
from corpusloom.plans import tables as tb
from test_model import Slow


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_makes_no_row_per_piece(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = plan_of(tokenize.tokenize_by_lookup(docs, tb.vocabulary(spark, SMALL), ["doc_id"]))
    assert "Generate" not in plan and "posexplode" not in plan


@pytest.mark.parametrize("most", [3, 1 << 19])
def test_lookup_equals_the_join(spark, chat_vocab, monkeypatch, most):
    """Repeated and null keys, null texts, texts beyond a slice."""
    monkeypatch.setattr(lookup, "SLICE_PIECES", most)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(20)
    vocab = vocabulary.piece_vocabulary(docs, 400)
    odd = [(None, "a b"), (None, "b aé\U0001f600"), (-1, None), (-1, "the the"), (-2, None), (-3, ""), (-4, "x<|endoftext|>y"), (-4, " the"), (-4, "zz")]
    rows = docs.unionByName(docs.limit(5)).unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    for special in (True, False):
        coded = lambda: sorted(map(str, tokenize.tokenize_by_lookup(rows, vocab, ["doc_id"], add_eos=True, allow_special=special).collect()))
        got = coded()
        with monkeypatch.context() as large:
            large.setattr(vocabulary, "BROADCAST_ROWS", 10)
            assert coded() == got


def test_texts_are_looked_up_where_they_are_read(spark, chat_vocab):
    """Only rows of repeated keys, null keys among them, are moved and become one."""
    docs = spark.range(0, 40, 1, 5).select("id", F.concat(F.lit("a"), F.col("id").cast("string")).alias("text"))
    coded = lambda df: [(r["id"], bytes(r["token_ids"]).decode()) for r in tokenize.tokenize_by_lookup(df, chat_vocab, ["id"]).collect()]
    assert coded(docs) == [(i, f"a{i}") for i in range(40)]
    odd = spark.createDataFrame([(None, "b"), (None, "b"), (3, "a3"), (-1, None), (-1, None)], "id bigint, text string")
    assert Counter(coded(docs.unionByName(odd))) == Counter([(None, "bb"), (-1, ""), (3, "aa33"), *((i, f"a{i}") for i in range(40) if i != 3)])


@pytest.mark.parametrize(("stretch", "records"), [(1, 2), (50, 3), (1 << 20, 10_000)])
def test_layout_sorts_ids_once(spark, monkeypatch, stretch, records):
    """Buckets of several documents, over batches and stretches; empty documents fill nothing."""
    some = np.random.default_rng(2)
    sizes = some.integers(0, 30, size=60).tolist()
    ids = {i: some.integers(0, 99, size=n).tolist() for i, n in enumerate(sizes)}
    rows = [("val" if i % 9 == 0 else "train", f"{i // 4:04x}", f"{i:06d}", t) for i, t in ids.items()]
    docs = spark.createDataFrame(rows, "split string, bucket string, order_key string, token_ids array<int>").repartition(7)
    monkeypatch.setattr(st, "STRETCH_TOKENS", stretch)
    monkeypatch.setattr(st, "TASK_TOKENS", stretch * 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        laid = st.lay_out_stream(docs, chunk=16)
        assert "collect_list" not in plan_of(laid)
        got = sorted((r["split"], r["chunk_id"], r["start_pos"], r["n_tokens"], r["tokens"]) for r in laid.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for split in ("train", "val"):
        whole = [t for r in rows if r[0] == split for t in r[3]]
        want += [(split, c // 16, c, len(whole[c : c + 16]), whole[c : c + 16]) for c in range(0, len(whole), 16)]
    assert got == want


def test_statistics_encode_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def ids(n):
        seen.add(1)
        return [1] * n

    coded = spark.range(12).select((F.col("id") % 2).alias("source"), ids(F.col("id").cast("int")).alias("token_ids"))
    rows = {r["source"]: (r["n_docs"], r["n_tokens"], r["p50"]) for r in metrics.token_statistics(coded, ["source"]).collect()}
    assert rows == {0: (6, 30, 4), 1: (6, 36, 5)} and seen.value == 12


@pytest.mark.parametrize("high", [3, 2**31 - 1])
def test_packed_triples(high):
    some = np.random.default_rng(1)
    arrays = [some.integers(-3, 4, size=n).astype(np.int32) for n in (0, 1, 2, 3, 400)] + [np.array([high, -3, high, -3, -high, 0], np.int32)]
    want = Counter(t for a in arrays for t in zip(a.tolist(), a.tolist()[1:], a.tolist()[2:]))
    assert {tuple(r[:3]): r[3] for r in zip(*(c.tolist() for c in lm.packed_triples(arrays)))} == want


def test_counting_explodes_edges_only(spark, monkeypatch):
    """Triples of all chunks are counted in arrays, whatever part of them is held at a time."""
    rows = [("train", c, [(c * 7 + i) % 5 for i in range(40)]) for c in range(6)]
    stream = spark.createDataFrame(rows, "split string, chunk_id bigint, tokens array<int>")
    ids = [-1, -1, *(t for r in rows for t in r[2])]
    for most in (1, 50, 1 << 20):
        monkeypatch.setattr(lm, "COUNTED_TOKENS", most)
        counts = lm.fit_lm(stream, 5).counts
        assert plan_of(counts).count("MapInArrow") == 1
        assert {tuple(r)[:3]: r["n"] for r in counts.collect()} == Counter(zip(ids, ids[1:], ids[2:]))


def test_unseen_tokens_are_counted_together(spark):
    """Triples that the model cannot tell apart are one row; estimates are those of the model token by token."""
    stream = spark.createDataFrame([("train", 0, [1, 2, 3, 1, 2, 3])], "split string, chunk_id bigint, tokens array<int>")
    model = lm.fit_lm(stream, 1000)
    far = list(range(100, 400))
    rows = spark.createDataFrame([(0, far[:-1], far[1:]), (1, [1, None, 2, 9], [2, 3, 1, 1, 5]), (2, None, [1])], "batch_id int, x array<int>, y array<int>")
    met = lm.met_batches(model, rows, ["batch_id"])
    assert [r["_n"] for r in met.filter("batch_id = 0").collect()] == [299]
    got = {r["batch_id"]: (r["loss"], r["n_targets"]) for r in lm.batch_scores(model, rows, ["batch_id"]).collect()}
    slow = Slow([1, 2, 3, 1, 2, 3], 1000)
    assert got[0] == (pytest.approx(-np.log(slow.prob(-1, 100, 101))), 299)
    assert got[1] == (pytest.approx(-np.log([slow.prob(-1, 1, 2), slow.prob(2, 9, 1)]).mean()), 2)
    assert np.isnan(got[2][0]) and got[2][1] == 0


def test_merging_moves_what_both_hold(spark):
    stream = spark.createDataFrame([("train", 0, list(range(60)))], "split string, chunk_id bigint, tokens array<int>")
    model = lm.fit_lm(stream, 100).counted()
    grown = lm.merged(model, spark.createDataFrame([(0, 1, 2, 5.0), (7, 7, 7, 1.0)], "w1 int, w2 int, w3 int, n double"))
    assert plan_of(grown.counts).count("FileScan parquet") == 3 and "Union" in plan_of(grown.counts)
    rows = {tuple(r)[:3]: r["n"] for r in grown.counts.collect()}
    assert rows == {(-1, -1, 0): 1.0, (-1, 0, 1): 1.0, (7, 7, 7): 1.0} | {(i, i + 1, i + 2): 6.0 if i == 0 else 1.0 for i in range(58)}


@pytest.mark.parametrize("rule", [generate.nucleus_chooser(0.7, 12, 0.9), generate.sample_chooser(0.8, 4)])
def test_a_model_in_files_draws_what_the_joins_draw(spark, monkeypatch, rule):
    """Beyond the bound of the arrays there is still one pass, not a job a token."""
    some = np.random.default_rng(2)
    tokens = [int(t) for t in some.integers(0, 11, size=900)]
    stream = spark.createDataFrame([("train", 0, tokens[:500]), ("train", 1, tokens[500:])], "split string, chunk_id bigint, tokens array<int>")
    model = lm.fit_lm(stream, 12).counted()
    rows = spark.createDataFrame([(0, [1]), (1, [1, 2]), (2, [11, 11]), (3, []), (4, [5, 11])], "prompt_id int, token_ids array<int>")
    made = [
        sorted(tuple(r) for r in generate.generate(rows, model, "prompt_id", 5, rule, rule.k, 5, stops=(3,), model_rows=a, file_rows=b).select("prompt_id", "new_ids").collect())
        for a, b in ((0, 10_000), (10_000, 0), (0, 0))
    ]
    assert made[0] == made[1] == made[2]
    monkeypatch.setattr(generate, "_drawn_step_by_step", None)
    assert generate.generate(rows, model, "prompt_id", 40, rule, rule.k, model_rows=0).count() == 5


def test_rows_are_found_across_blocks(spark, monkeypatch):
    """Keys of one row and of several blocks, keys that are not there, files in any number."""
    keys = [3, 3, *[7] * 2_000, 9, *range(20, 900), 5_000_000_000]
    rows = spark.createDataFrame([(k, i, float(i), 1.0, 0.5) for i, k in enumerate(keys)], "key bigint, id int, hits double, seen double, lower double")
    held = rowfile.opened(rowfile.publish(rows.repartition(5)))
    for key in (3, 7, 9, 20, 531, 899, 5_000_000_000, 0, 8, 900, 6_000_000_000):
        assert held.find(key)["id"].tolist() == [i for i, k in enumerate(keys) if k == key]


@pytest.mark.parametrize("most", [1, 5, 1 << 17])
def test_encoding_and_spelling_by_slices(spark, monkeypatch, most):
    """Batches are worked on in bounded slices of whole rows; nulls and empty texts keep their place."""
    texts = ["aa ab", None, "", "b" * 70, "aab abab é", None, "", "x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    vocab = bpe.learn_vocabulary(rows, 6)
    ranks = {bytes(r["token"]): r["token_id"] for r in vocab.table.filter("NOT is_special").collect()}
    want = [[i for p in r["p"] or [] for i in bpe.merge_piece(p.encode(), ranks)] for r in rows.orderBy("doc_id").select(pieces(F.col("text")).alias("p")).collect()]
    monkeypatch.setattr(bpe, "SLICE_PIECES", most)
    monkeypatch.setattr(bpe, "MEMO_PIECES", 2)
    coded = tokenize.tokenize(rows, vocab)
    assert [r["token_ids"] for r in coded.orderBy("doc_id").collect()] == want
    back = tokenize.detokenize(coded, vocab, ["doc_id"]).orderBy("doc_id").collect()
    assert [r["text"] for r in back] == [t or "" for t in texts]
    if most < 10:
        sizes = np.array([3, 0, 9, 1, 1])
        assert [(a, b) for a, b in lookup.row_slices(sizes, 5)] == [(0, 2), (2, 3), (3, 5)]


def test_pieces_are_counted_once(spark, monkeypatch):
    """A query with a vocabulary and a model of the same documents counts their pieces once."""
    from __spark_entry__ import queries

    counted = []
    count = vocabulary.count_pieces
    monkeypatch.setattr(vocabulary, "count_pieces", lambda *a: counted.append(1) or count(*a))
    for name in ("next_candidates", "finetuned_counts"):
        counted.clear()
        queries()[name](spark, SMALL)
        assert len(counted) == 1
