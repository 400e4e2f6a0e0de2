"""The n-gram model and generation against brute force; plans and partitioning."""

import hashlib
import math
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from corpusloom.operators import decoding, generate, language_model as lm, metrics, ordered, shuffle, skew, stream, versions
from corpusloom.plans import tables as tb
from corpusloom.sources.tables import STREAM_SCHEMA

SIZE = 12
TIED = [1, 2, 3, 1, 2, 4, 1, 2, 5, 1, 2, 6, 1, 2, 7, 1, 2, 8, 1, 2, 9, 1, 2, 10]  # eight followers, once each
IDS = [1, 2, 3, 1, 2, 4, 1, 2, 3, 5, 6, 1, 2, 3, 7, 7, 7, 2, 3, 1]


class Slow:
    """The interpolated model, one token at a time."""

    def __init__(self, ids, size=SIZE, weight=0.7):
        self.size, self.weight = size, weight
        seen = [-1, -1, *ids]
        self.tri = Counter(zip(seen, seen[1:], seen[2:]))

    def prob(self, w1, w2, w3):
        lower = 1 / self.size
        for keep in (0, 1, 2):
            context = (w1, w2)[2 - keep :]
            hits = sum(n for t, n in self.tri.items() if t[2 - keep :] == (*context, w3))
            seen = sum(n for t, n in self.tri.items() if t[2 - keep : 2] == context)
            if seen:
                lower = self.weight * hits / seen + (1 - self.weight) * lower
        return lower


def fitted(spark, ids=IDS, chunk=6):
    rows = [("train", at // chunk, at, len(ids[at : at + chunk]), ids[at : at + chunk]) for at in range(0, len(ids), chunk)]
    return lm.fit_lm(spark.createDataFrame(rows, STREAM_SCHEMA), SIZE)


@pytest.mark.parametrize("chunk", [2, 6, 100])
def test_counts_cross_chunks(spark, chunk):
    found = {(r["w1"], r["w2"], r["w3"]): r["n"] for r in fitted(spark, chunk=chunk).counts.collect()}
    assert found == Slow(IDS).tri


def test_scores(spark):
    slow = Slow(IDS)
    x, y = [1, 2, 9, 1, 2], [2, 3, 1, -1, 11]
    rows = spark.createDataFrame([(0, x, y), (1, [3], [-1])], "batch_id int, x array<int>, y array<int>")
    context = [-1, *x]
    want = {i: math.log(slow.prob(context[i], x[i], y[i])) for i in range(5) if y[i] != -1}
    scored = lm.score(fitted(spark), rows, ["batch_id"]).filter("batch_id = 0").collect()
    assert {r["pos"]: r["log_prob"] for r in scored if r["log_prob"] is not None} == pytest.approx(want)
    losses = {r["batch_id"]: r["loss"] for r in lm.batch_scores(fitted(spark), rows, ["batch_id"]).collect()}
    assert losses[0] == pytest.approx(-sum(want.values()) / 4) and math.isnan(losses[1])


def test_probabilities_sum_to_one(spark):
    slow = Slow(IDS)
    contexts = spark.createDataFrame([(1, 2), (9, 3), (9, 9), (-1, -1)], "w1 int, w2 int")
    offered = lm.candidates(fitted(spark).stored(), contexts, SIZE).collect()
    found = defaultdict(dict)
    for r in offered:
        found[r["w1"], r["w2"]][r["token_id"]] = math.exp(r["logit"])
    for (w1, w2), probs in found.items():
        assert probs == pytest.approx({t: slow.prob(w1, w2, t) for t in range(SIZE)})
        assert sum(probs.values()) == pytest.approx(1)
    assert len(found) == 4


@pytest.mark.parametrize("k", [1, 3, 5])
def test_pruned_candidates_hold_the_top_values(spark, k):
    slow = Slow(IDS)
    contexts = spark.createDataFrame([(1, 2), (7, 7), (9, 3), (9, 9)], "w1 int, w2 int")
    found = defaultdict(list)
    for r in lm.candidates(fitted(spark).stored(), contexts, k).collect():
        found[r["w1"], r["w2"]].append(math.exp(r["logit"]))
    for (w1, w2), probs in found.items():
        want = sorted((slow.prob(w1, w2, t) for t in range(SIZE)), reverse=True)[:k]
        assert sorted(probs, reverse=True)[:k] == pytest.approx(want)


def slow_generate(slow, key, prompt, n, t, k, p, seed):
    ids = [-1, -1, *prompt]
    for step in range(n):
        logits = sorted(((math.log(slow.prob(ids[-2], ids[-1], w)) / t, w) for w in range(SIZE)), key=lambda e: (-e[0], e[1]))
        floor = logits[min(k, SIZE) - 1][0]
        kept = [(math.exp(v), w) for v, w in logits if v >= floor]
        total, mass, inside = sum(e for e, _ in kept), 0.0, []
        for e, w in kept:
            if mass / total < p or not inside:
                inside.append((e, w))
            mass += e
        total = sum(e for e, _ in inside)
        digest = hashlib.md5(f"{seed}:{key}:{step}".encode()).hexdigest()
        u, cum = int(digest[:15], 16) / 2**60, 0.0
        for e, w in inside:
            cum += e / total
            if cum > u:
                break
        ids.append(w)
    return ids[2:]


def test_ties_at_the_last_place_stay(spark):
    slow, model = Slow(TIED, 40), lm.resize_vocab(fitted(spark, TIED), 40).stored()
    contexts = spark.createDataFrame([(1, 2), (5, 1), (30, 30)], "w1 int, w2 int")
    for k in (1, 3, 8, 20):
        found = defaultdict(dict)
        for r in decoding.top_k(lm.candidates(model, contexts, k), ["w1", "w2"], k).collect():
            found[r["w1"], r["w2"]][r["token_id"]] = math.exp(r["logit"])
        for (w1, w2), kept in found.items():
            probs = {t: slow.prob(w1, w2, t) for t in range(40)}
            floor = sorted(probs.values(), reverse=True)[k - 1]
            assert set(kept) == {t for t, p in probs.items() if p > floor * (1 - 1e-9)}


@pytest.mark.parametrize("t, k, p", [(0.7, SIZE, 0.9), (1.0, SIZE, 1.0), (0.3, SIZE, 0.61), (0.7, 3, 0.95), (1.0, 1, 1.0)])
def test_generation_equals_brute_force(spark, t, k, p):
    prompts = [(0, [1]), (1, [1, 2]), (2, [9, 9]), (3, [7]), (4, [])]
    rows = spark.createDataFrame(prompts, "prompt_id int, token_ids array<int>")
    made = generate.generate(rows, fitted(spark), "prompt_id", 5, generate.nucleus_chooser(t, k, p), k, seed=3)
    slow = Slow(IDS)
    assert {r["prompt_id"]: r["token_ids"] for r in made.collect()} == {
        key: slow_generate(slow, key, ids, 5, t, k, p, 3) for key, ids in prompts
    }


@pytest.mark.parametrize("rule", [generate.nucleus_chooser(0.7, SIZE, 0.9), generate.nucleus_chooser(1.0, 3, 1.0), generate.sample_chooser(0.8, 4)])
def test_one_pass_draws_what_the_joins_draw(spark, rule):
    """The model in the tasks or joined step by step, with and without stop tokens."""
    prompts = [(0, [1]), (1, [1, 2]), (2, [9, 9]), (3, [7]), (4, []), (5, [11]), (6, [5, 6])]
    rows = spark.createDataFrame(prompts, "prompt_id int, token_ids array<int>")
    for stops in ((), (3, 7)):
        made = [
            {r["prompt_id"]: r["new_ids"] for r in generate.generate(rows, fitted(spark), "prompt_id", 6, rule, rule.k, 5, stops=stops, model_rows=most).collect()}
            for most in (1_000, 0)
        ]
        assert made[0] == made[1] and set(made[0]) == set(range(7))
        for new in made[0].values():
            ends = [i for i, w in enumerate(new) if w in stops]
            assert len(new) == (ends[0] + 1 if ends else 6)


def test_long_sequences_equal_brute_force(spark):
    prompts = [(key, [key % 9]) for key in range(12)]
    rows = spark.createDataFrame(prompts, "prompt_id int, token_ids array<int>")
    made = generate.generate(rows, fitted(spark), "prompt_id", 120, generate.nucleus_chooser(0.9, 6, 0.8), 6, seed=1)
    slow = Slow(IDS)
    assert {r["prompt_id"]: r["token_ids"] for r in made.collect()} == {
        key: slow_generate(slow, key, ids, 120, 0.9, 6, 0.8, 1) for key, ids in prompts
    }


def test_saved_model_goes_on(spark, tmp_path):
    model = lm.resize_vocab(fitted(spark), SIZE + 4)
    lm.save_model(model, str(tmp_path / "v1"))
    loaded = lm.load_model(spark, str(tmp_path / "v1"))
    assert (loaded.size, loaded.weight, loaded.step) == (SIZE + 4, 0.7, 0)
    more = spark.createDataFrame([("train", 0, 0, 3, [1, 2, 3])], STREAM_SCHEMA)
    grown = lm.resume_lm(loaded, more)
    total = grown.counts.agg(F.sum("n")).first()[0]
    assert grown.step == 1 and total == len(IDS) + 3


def test_uniform_model(spark):
    empty = lm.NgramModel(spark.createDataFrame([], "w1 int, w2 int, w3 int, n double"), 50)
    rows = spark.createDataFrame([(0, [1, 2], [2, 3])], "batch_id int, x array<int>, y array<int>")
    assert lm.batch_scores(empty, rows, ["batch_id"]).first()["loss"] == pytest.approx(math.log(50))


def test_versions(spark, tmp_path):
    """Best and latest come from the log; a version that was not committed is not there; old ones go."""
    root = str(tmp_path / "versions")
    with pytest.raises(LookupError):
        versions.load_version(spark, root)
    model = fitted(spark)
    names = []
    for step, loss in enumerate([3.0, 1.5, float("nan"), 2.5, 1.5]):
        names.append(versions.save_version(replace(model, step=step, val_loss=loss), root, {"seq": step}, keep=2))
    lm.save_model(replace(model, step=99, val_loss=0.0), f"{root}/v000009-dead")  # its run died before the log
    assert {r["name"] for r in versions.versions(spark, root).collect()} == {names[1], names[3], names[4]}
    assert sorted(p.name for p in (tmp_path / "versions").glob("v*")) == [names[1], names[3], names[4], "v000009-dead"]
    best, config = versions.load_version(spark, root, "best")
    assert (best.step, best.val_loss, config) == (1, 1.5, {"seq": 1}) and best.counts.count() == model.counts.count()
    assert versions.load_version(spark, root)[0].step == 4 and versions.load_version(spark, root, names[3])[1] == {"seq": 3}
    with pytest.raises(LookupError):
        versions.load_version(spark, root, names[0])


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_is_the_plain_join(spark, how):
    """One key holds two thirds of the rows, another a tenth; some keys are null, missing or twice on the right."""
    rows = [(7 if i % 3 else i % 40, "x" if i % 5 else None, i // 2) for i in range(600)] + [(None, "x", 1)] * 3 + [(7, "x", 1)] * 50
    many = spark.createDataFrame(rows, "a int, b string, v int")
    few = spark.createDataFrame([(i, "x", i * 10) for i in range(0, 40, 2)] + [(7, "x", 70), (7, "x", 71), (None, "x", 5)], "a int, b string, w int")
    want = many.join(few, ["a", "b"], how).select("a", "b", "v", "w").collect()
    got = skew.split_join(many, few, ["a", "b"], how)
    assert got.columns == ["a", "b", "v", "w"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want))
    assert skew.split_join(many.filter("false"), few, ["a", "b"], how).count() == 0


def test_a_frequent_key_is_spread(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for name, value in (("spark.sql.shuffle.partitions", "16"), ("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(name, value)
    try:
        many = spark.range(32_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"), "id")
        few = many.select("k").distinct().withColumn("w", F.col("k") * 2)
        sizes = lambda df: sorted(r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        plain, split = sizes(many.join(few, "k")), sizes(skew.split_join(many, few, ["k"]))
        assert sum(plain) == sum(split) == 32_000 and plain[-1] > 10_000 and split[-1] < 5_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scores_of_a_stream_with_one_token_in_a_third_of_places(spark):
    ids = [1, 1, 1, 2, 3, 1, 4, 1, 1, 5, 6, 7] * 12
    slow = Slow(ids)
    rows = spark.createDataFrame([(i, ids[i : i + 9], ids[i + 1 : i + 10]) for i in range(0, 90, 9)], "batch_id int, x array<int>, y array<int>")
    losses = {r["batch_id"]: r["loss"] for r in lm.batch_scores(fitted(spark, ids), rows, ["batch_id"]).collect()}
    for i in range(0, 90, 9):
        context = [-1, *ids[i : i + 9]]
        want = -sum(math.log(slow.prob(context[j], context[j + 1], ids[i + 1 + j])) for j in range(9)) / 9
        assert losses[i] == pytest.approx(want)


# --- ordered operators ------------------------------------------------------------------


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_running_measures(spark, width):
    values = [(g, i, (i * 7) % 5 if i % 3 else None) for g in "ab" for i in range(20)]
    rows = spark.createDataFrame(values, "g string, i bigint, v int")
    kinds = {k: (k, F.col("v")) for k in ("sum", "min", "max", "count", "last")}
    for inclusive in (True, False):
        out = ordered.running(rows, ["g"], "i", kinds, width, inclusive).collect()
        for r in out:
            upto = [v for g, i, v in values if g == r["g"] and (i <= r["i"] if inclusive else i < r["i"]) and v is not None]
            want = (sum(upto), min(upto), max(upto), len(upto), upto[-1]) if upto else None
            got = tuple(r[k] for k in kinds)
            assert got == want if want else not any(got)


def test_positions_are_the_seeded_order(spark):
    rows = shuffle.shuffled(spark.range(500), ["id"], 9).collect()
    want = sorted(range(500), key=lambda i: hashlib.md5(f"9:{i}".encode()).hexdigest())
    assert [r["id"] for r in sorted(rows, key=lambda r: r["position"])] == want


# --- plans ------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_plan_puts_all_rows_into_one_window(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    split = shuffle.split_corpus(docs.select("doc_id", "text"), ["doc_id"])
    coded = split.withColumn("token_ids", F.array(F.lit(1)))
    steps = tb.steps(spark, SMALL)
    for df in (split, stream.lay_out_stream(coded), metrics.progress(steps, ["run"], 1, 10)):
        plan = plan_of(df)
        for line in (x for x in plan.splitlines() if "Window [" in x):
            assert "windowspecdefinition(" in line and not line.split("windowspecdefinition(")[1].startswith("specified")
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_split_moves_no_text(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = plan_of(shuffle.split_corpus(docs.select("doc_id", "text"), ["doc_id"]).select("doc_id", "text", "split"))
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1  # the final pass, unshuffled
    assert plan.count("ReadSchema: struct<doc_id:bigint>") >= 2


def test_tokens_are_split_by_the_ids_alone(spark, monkeypatch):
    from corpusloom.operators.tokenize import byte_tokenize
    from corpusloom.plans import pretrain

    monkeypatch.setattr(pretrain, "stage", lambda df, *_: df)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = plan_of(pretrain.tokenized_corpus(docs, byte_tokenize))
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1


def test_lookup_shuffles_texts_once(spark):
    vocab = tb.vocabulary(spark, SMALL)
    from corpusloom.operators.tokenize import tokenize_by_lookup

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = plan_of(tokenize_by_lookup(docs, vocab, ["doc_id"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_windows_join_by_chunk(spark):
    source = tb.stream(spark, SMALL)
    plan = plan_of(stream.sample_windows(source, "train", 16, 50, chunk=tb.CHUNK))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_windows_of_a_hot_chunk(spark, monkeypatch, most):
    monkeypatch.setattr(stream, "BROADCAST_DRAWS", most)
    tokens = list(range(1000))
    chunks = [("val", i // 64, i, len(tokens[i : i + 64]), tokens[i : i + 64]) for i in range(0, 1000, 64)]
    laid = spark.createDataFrame(chunks, "split string, chunk_id bigint, start_pos bigint, n_tokens int, tokens array<int>")
    offsets = spark.createDataFrame([(i, 70 + i % 3) for i in range(300)] + [(300 + i, 41 * i) for i in range(24)], "window_id bigint, offset bigint")
    rows = stream.read_windows(laid, offsets, 16, chunk=64).collect()
    assert sorted((r["window_id"], r["offset"], r["tokens"]) for r in rows) == [
        (r["window_id"], r["offset"], tokens[r["offset"] : r["offset"] + 17]) for r in offsets.orderBy("window_id").collect()
    ]


def test_chunks_stay_where_they_are_read(spark):
    laid = tb.stream(spark, SMALL).select("chunk_id", "start_pos", "tokens")
    draws = laid.select("chunk_id", F.col("chunk_id").alias("window_id"), F.col("start_pos").alias("offset"))
    plan = plan_of(stream._touching(draws, laid))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("partitions", ["1", "32"])
def test_partitioning_does_not_matter(spark, partitions):
    def rows():
        s = tb.stream(spark, SMALL)
        windows = stream.sample_windows(s, "train", 16, 50, chunk=tb.CHUNK)
        drawn = decoding.draw(
            decoding.softmax(tb.conversation_logits(spark, SMALL, tb.vocabulary(spark, SMALL)), ["conv_id"]), ["conv_id"], 1
        )
        return (
            sorted((r["split"], r["chunk_id"], tuple(r["tokens"])) for r in s.collect()),
            sorted((r["window_id"], tuple(r["x"])) for r in windows.collect()),
            sorted(map(tuple, drawn.collect())),
        )

    usual = rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert rows() == usual
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
