"""Hand-computed cases."""

import math

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import measures
from corpusloom.operators import batches, chat, decoding, examples, metrics, prepare, runs, shuffle, stream
from corpusloom.sources.tables import STREAM_SCHEMA

END, USER, CUE, EOS = 260, 258, 259, 256


def one(df, *columns):
    row = df.first()
    return tuple(row[c] for c in columns) if len(columns) > 1 else row[columns[0]]


def test_mask_covers_answer_and_its_end(spark, chat_vocab):
    turns = spark.createDataFrame(
        [(1, 0, "user", [1, 2]), (1, 1, "assistant", [3])], "conv_id int, turn bigint, role string, token_ids array<int>"
    )
    ids, mask = one(chat.encode_chat(turns, chat_vocab, ["conv_id"], 8), "token_ids", "loss_mask")
    assert ids == [USER, 1, 2, END, CUE, 3, END, EOS]
    assert mask == [0, 0, 0, 0, 0, 1, 1, 0]


def test_length_limit_is_twice_the_sequence(spark, chat_vocab):
    schema = "conv_id int, turn bigint, role string, token_ids array<int>"
    turns = spark.createDataFrame([(1, 0, "user", [1] * 5), (2, 0, "user", [1] * 6)], schema)
    kept = chat.encode_chat(turns, chat_vocab, ["conv_id"], 4).collect()
    assert [(r["conv_id"], len(r["token_ids"])) for r in kept] == [(1, 8)]


@pytest.mark.parametrize(
    "ids, mask, x, y",
    [
        ([7, 8, 9], [0, 1, 1], [7, 8, 9, 0], [8, 9, -1, -1]),
        ([1, 2, 3, 4, 5, 6, 7, 8], [1] * 8, [1, 2, 3, 4], [2, 3, 4, 5]),
    ],
)
def test_tensors(spark, ids, mask, x, y):
    rows = spark.createDataFrame([(ids, mask)], "token_ids array<int>, loss_mask array<int>")
    assert one(examples.to_tensors(rows, 4), "x", "y") == (x, y)


@pytest.mark.parametrize("n, fraction, val", [(1000, 0.005, 5), (10, 0.005, 1), (1, 0.005, 1)])
def test_corpus_split_counts(spark, n, fraction, val):
    rows = shuffle.split_corpus(spark.range(n), ["id"], fraction)
    assert rows.filter("split = 'val'").count() == val
    last = rows.orderBy(F.desc("order_key")).limit(val).filter("split = 'val'").count()
    assert last == val


@pytest.mark.parametrize("n, fraction, val", [(100, 0.02, 2), (10, 0.02, 1), (10, 0.0, 0), (3, 1.0, 3)])
def test_example_split_counts(spark, n, fraction, val):
    rows = shuffle.split_examples(spark.range(n), ["id"], fraction)
    assert rows.filter("split = 'val'").count() == val
    first = rows.orderBy("order_key").limit(val).filter("split = 'val'").count() if val else 0
    assert first == val


def test_window_starts_leave_out_the_last(spark):
    found = {r["offset"] for r in stream.draw_offsets(spark, F.lit(10), 400, 4).collect()}
    assert found == {0, 1, 2, 3, 4}


def test_too_short_stream_is_an_error(spark):
    with pytest.raises(Exception, match="too short"):
        stream.draw_offsets(spark, F.lit(5), 1, 4).collect()


def test_ranks_pad_from_the_start(spark):
    rows = batches.shard(spark.range(5), ["id"], 2).collect()
    by_rank = {r: [x["id"] for x in rows if x["rank"] == r] for r in (0, 1)}
    assert len(by_rank[0]) == len(by_rank[1]) == 3
    assert len(set(by_rank[0] + by_rank[1])) == 5


def test_ranks_pad_in_cycles(spark):
    rows = batches.shard(spark.range(2), ["id"], 5).collect()
    assert sorted(r["rank"] for r in rows) == [0, 1, 2, 3, 4]


def test_short_batch_is_dropped(spark):
    rows = batches.batches(batches.shard(spark.range(10), ["id"], 1), 4).collect()
    assert len(rows) == 8 and {r["batch_id"] for r in rows} == {0, 1}


def test_schedule_wraps_epochs(spark):
    rows = batches.schedule(spark.range(10), ["id"], 3, 2, 4).collect()
    assert sorted({(r["step"], r["micro_step"], r["epoch"], r["batch_id"]) for r in rows}) == [
        (0, 0, 0, 0), (0, 1, 0, 1), (1, 0, 1, 0), (1, 1, 1, 1), (2, 0, 2, 0), (2, 1, 2, 1),
    ]
    orders = [[r["id"] for r in sorted(rows, key=lambda r: (r["batch_id"], r["slot"])) if r["epoch"] == e] for e in range(3)]
    assert len({tuple(o) for o in orders}) == 3


def test_learning_rate(spark):
    steps = spark.createDataFrame([(s,) for s in (0, 9, 10, 60, 110)], "step int")
    rates = runs.with_schedule(steps, 1.0, 0.1, 10, 110).orderBy("step").collect()
    assert [r["lr"] for r in rates] == pytest.approx([0.1, 1.0, 1.0, 0.55, 0.1])


@pytest.mark.parametrize("recent, arrow", [(1.0, "↓"), (2.01, "→"), (2.5, "↑")])
@pytest.mark.parametrize("width", [7, 100_000])
def test_trend(spark, recent, arrow, width):
    rows = [("r", i, 2.0 if i < 40 else recent) for i in range(50)]
    steps = spark.createDataFrame(rows, "run string, step bigint, loss double")
    found = {r["step"]: r["trend"] for r in runs.loss_trend(steps, ["run"], width=width).collect()}
    assert found[49] == arrow and found[48] == "" and len(found) == 50


def test_infinite_loss_is_capped(spark):
    empty = spark.createDataFrame([], "loss double")
    row = metrics.overall_loss(empty).withColumn("p", measures.perplexity(F.col("loss"))).first()
    assert row["loss"] == math.inf and row["p"] == pytest.approx(485165195.41, abs=0.01)


def test_fully_masked_batch_poisons_the_mean(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 1, None)], "run string, batch_id int, nll double")
    per_batch = metrics.batch_losses(rows, ["run", "batch_id"])
    assert math.isnan(metrics.mean_loss(per_batch, ["run"]).first()["loss"])
    assert metrics.token_weighted_loss(per_batch, ["run"]).first()["loss"] == 1.0


def test_log_normalizer_does_not_overflow(spark):
    rows = spark.createDataFrame([(0, 900.0), (0, 900.0), (0, -900.0), (1, 0.5)], "p int, logit double")
    found = {r["p"]: r["log_norm"] for r in metrics.log_normalizer(rows, ["p"]).collect()}
    assert found == pytest.approx({0: 900 + math.log(2), 1: 0.5})


def logits(spark, values):
    return spark.createDataFrame([(0, i, float(v)) for i, v in enumerate(values)], "s int, token_id int, logit double")


def test_top_k_keeps_ties_and_sampler_does_not(spark):
    rows = logits(spark, [3, 2, 2, 1])
    assert decoding.top_k(rows, ["s"], 2).count() == 3
    assert decoding.top_k(rows, ["s"], 0).count() == 4
    assert decoding.sample_distribution(rows, ["s"], k=2).count() == 2


@pytest.mark.parametrize("p, kept", [(0.75, 2), (0.45, 1), (1.0, 3), (0.0, 1)])
def test_nucleus(spark, p, kept):
    rows = logits(spark, [math.log(0.5), math.log(0.3), math.log(0.2)])
    assert decoding.nucleus(rows, ["s"], p).count() == kept


def test_draws_follow_the_distribution(spark):
    rows = spark.range(4000).selectExpr("id AS s").selectExpr(
        "s", "inline(array(struct(0 AS token_id, ln(0.75D) AS logit), struct(1 AS token_id, ln(0.25D) AS logit)))"
    )
    drawn = decoding.draw(decoding.softmax(rows, ["s"]), ["s"], 5)
    assert drawn.filter("token_id = 0").count() == pytest.approx(3000, abs=120)


@pytest.mark.parametrize("ids, left", [([1, END, 2, EOS], [1]), ([1, EOS, 2, END], [1]), ([1, 2], [1, 2]), ([END], [])])
def test_stop_tokens(spark, chat_vocab, ids, left):
    rows = spark.createDataFrame([(ids,)], "ids array<int>")
    assert one(rows.select(chat.cut_reply(F.col("ids"), chat_vocab).alias("r")), "r") == left


@pytest.mark.parametrize("budget, kept", [(11, [1, 2]), (0, [2]), (16, [0, 1, 2])])
def test_history_budget(spark, chat_vocab, budget, kept):
    rows = [(1, t, "user", [1, 2, 3]) for t in range(3)]  # five tokens each once framed
    turns = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, token_ids array<int>")
    left = chat.trim_history(turns, chat_vocab, ["conv_id"], 20 + budget, 20)
    assert sorted(r["turn"] for r in left.collect()) == kept


def test_empty_field_is_no_reason_to_look_further(spark):
    rows = spark.createDataFrame([(1, "", "hi", "yo")], "id int, prompt string, instruction string, response string")
    assert prepare.to_chat(rows, "generic", ["id"]).count() == 0


def test_null_fields_of_mixed_tables_are_absent(spark):
    rows = spark.createDataFrame(
        [(1, "x/dolly", "do", "done", None, None), (2, "own", None, None, "why", "so"), (3, "own", "", "r", "why", "so")],
        "id int, dataset string, instruction string, response string, question string, answer string",
    )
    sides = prepare.to_chat_by_source(rows, "dataset", ["id"])
    assert sorted((r["id"], r["user"], r["assistant"]) for r in sides.collect()) == [(1, "do", "done"), (2, "why", "so")]


def test_unknown_role_is_an_error(spark, chat_vocab):
    turns = spark.createDataFrame([(1, 0, "tool", [1])], "conv_id int, turn bigint, role string, token_ids array<int>")
    with pytest.raises(Exception, match="unknown role: tool"):
        chat.encode_chat(turns, chat_vocab, ["conv_id"], 8).collect()


def test_target_without_logit_is_infinite(spark):
    logits = spark.createDataFrame([(0, 1, 0.0), (0, 2, 0.0), (1, 1, 0.0)], "pos int, token_id int, logit double")
    targets = spark.createDataFrame([(0, 1), (1, 2), (2, 1), (3, -1)], "pos int, y int")
    losses = {r["pos"]: r["nll"] for r in metrics.token_losses(logits, targets, ["pos"]).collect()}
    assert losses == {0: pytest.approx(math.log(2)), 1: math.inf, 2: math.inf, 3: None}


def test_white_space_is_not_missing(spark):
    rows = spark.createDataFrame([(1, "q", "  ", "a"), (2, "", "c", "a"), (3, "q", None, None)], "id int, instruction string, context string, response string")
    assert [(r["id"], r["user"]) for r in prepare.to_chat(rows, "dolly", ["id"]).collect()] == [(1, "q\n\nContext:   ")]


def test_best_is_strict(spark):
    rows = [("r", 1, 2.0), ("r", 2, 2.0), ("r", 3, 1.5)]
    evals = spark.createDataFrame(rows, "run string, step bigint, val_loss double")
    flags = [r["is_best"] for r in metrics.best_so_far(evals, ["run"]).orderBy("step").collect()]
    assert flags == [True, False, True]
    assert one(metrics.best_checkpoint(evals.filter("step < 3"), ["run"]), "best_step") == 1


@pytest.mark.parametrize("text, seconds", [("59s", 59), ("12m", 720), ("1h02m", 3720), ("soon", None)])
def test_elapsed(spark, text, seconds):
    rows = spark.createDataFrame([(text,)], "t string")
    assert one(rows.select(measures.elapsed_seconds(F.col("t")).alias("s")), "s") == seconds


def test_styles():
    names = {"databricks-dolly-15k": "dolly", "alpaca-cleaned": "alpaca", "squad": "generic", "dolly-alpaca": "dolly"}
    assert {n: prepare.style_for(n) for n in names} == names


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 50])
@pytest.mark.parametrize("n", [0, 1, 2, 5, 6, 11])
def test_consecutive_windows(spark, chunk, n):
    """Each token but the first is a target once, whatever the chunks."""
    ids = list(range(100, 100 + n))
    rows = [("val", at // chunk, at, len(ids[at : at + chunk]), ids[at : at + chunk]) for at in range(0, n, chunk)] + [("train", 0, 0, 1, [7])]
    out = stream.consecutive_windows(spark.createDataFrame(rows, STREAM_SCHEMA), "val", 5).collect()
    assert sorted((r["window_id"], r["x"], r["y"]) for r in out) == [
        (w, ids[w * 5 : min(w * 5 + 5, n - 1)], ids[w * 5 + 1 : w * 5 + 6]) for w in range((max(n - 1, 0) + 4) // 5)
    ]


def test_counters_of_a_write_come_from_the_write(spark):
    """Each row is worked on once: the rows kept and the counters are one pass."""
    touched = spark.sparkContext.accumulator(0)

    def touch(n):
        touched.add(1)
        return n

    rows = spark.range(50).select("id", F.when(F.col("id") % 7 > 0, F.udf(touch, "bigint")("id")).alias("n")).repartition(4)
    table, seen = metrics.stage_with_counters(rows, F.col("n").isNotNull() & (F.col("n") < 40), F.col("n"), "kept")
    kept = [n for n in range(40) if n % 7]
    assert seen == {"written": len(kept), "skipped": None, "tokens_written": sum(kept)} | {"skipped": 50 - len(kept)}
    assert sorted(r["n"] for r in table.collect()) == kept and touched.value == 50
