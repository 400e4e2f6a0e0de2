"""Token files, logs, corpora, streams of files."""

import json
import struct
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import SMALL
from corpusloom.operators import stream, vocabulary
from corpusloom.plans import tables as tb
from corpusloom.session import shared_folder, stage
from corpusloom.sources import corpus, tables, tokenbin, trainlog
from corpusloom.streaming.rowwise import follow_instructions, instruction_tensors


def chunks(spark, ids, split="train", chunk=4):
    rows = [(split, at // chunk, at, len(ids[at : at + chunk]), ids[at : at + chunk]) for at in range(0, len(ids), chunk)]
    return spark.createDataFrame(rows, tables.STREAM_SCHEMA)


def read_ids(df):
    return [i for r in df.orderBy("start_pos").collect() for i in r["tokens"]]


def test_header_and_bytes(spark, tmp_path):
    tokenbin.write_token_bin(chunks(spark, [1, 258, 65535]), str(tmp_path / "t"), 65_536)
    (shard,) = (tmp_path / "t").glob("*.bin")
    assert shard.read_bytes() == bytes.fromhex("544C4C4D 0100 0000 0100 0201 FFFF")
    assert read_ids(tokenbin.read_token_bin(spark, str(tmp_path / "t"))) == [1, 258, 65535]


def test_wide_ids(spark, tmp_path):
    ids = list(range(69_990, 70_010))
    tokenbin.write_token_bin(chunks(spark, ids), str(tmp_path / "t"), 70_010)
    assert read_ids(tokenbin.read_token_bin(spark, str(tmp_path / "t"))) == ids
    assert json.loads((tmp_path / "t" / "_manifest.json").read_text())["dtype"] == 1


def test_narrow_ids_are_checked(spark, tmp_path):
    with pytest.raises(Exception, match="vocabSize"):
        tokenbin.write_token_bin(chunks(spark, [70_000]), str(tmp_path / "t"), 100)


@pytest.mark.parametrize("raw, message", [(b"NOPE\1\0\0\0", "not a token file"), (b"TLLM\2\0\0\0", "version 2")])
def test_bad_headers(spark, tmp_path, raw, message):
    (tmp_path / "x.bin").write_bytes(raw)
    with pytest.raises(Exception, match=message):
        tokenbin.read_token_bin(spark, str(tmp_path / "x.bin")).collect()


def test_plain_files(spark, tmp_path):
    (tmp_path / "train.bin").write_bytes(b"TLLM" + struct.pack("<HH3H", 1, 0, 7, 8, 9) + b"\xff")
    (tmp_path / "val.bin").write_bytes(b"TLLM" + struct.pack("<HH", 1, 0))
    rows = tokenbin.read_token_bin(spark, str(tmp_path)).collect()
    assert [(r["split"], r["tokens"]) for r in rows] == [("train", [7, 8, 9])]


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    tokenbin.write_token_bin(chunks(spark, list(range(100))), str(tmp_path / "t"), 100)
    read = spark.read.format("tokenbin").option("chunk", 4).option("tokensPerTask", 16).load(str(tmp_path / "t"))
    assert read.rdd.getNumPartitions() == 7 and read_ids(read) == list(range(100))


def test_only_shards_asked_for_are_opened(spark, tmp_path):
    """Filters prune at planning, from the manifest alone."""
    rows = [("train", c, 10 * c, 10, list(range(10 * c, 10 * c + 10))) for c in range(40)] + [("val", 0, 0, 3, [7, 8, 9])]
    path = str(tmp_path / "t")
    tokenbin.write_token_bin(spark.createDataFrame(rows, tables.STREAM_SCHEMA), path, 1000)
    read = lambda: spark.read.format("tokenbin").option("chunk", 10).option("tokensPerTask", 50).load(path)
    every = sorted((r["split"], r["start_pos"], r["tokens"]) for r in read().collect())
    assert every == sorted((s, p, t) for s, _, p, _, t in rows)
    assert read().rdd.getNumPartitions() >= 9
    for asked, n in (("split = 'val'", 1), ("split IN ('val', 'x')", 1), ("split = 'train' AND start_pos < 100", None), ("start_pos >= 370 AND split <> 'val'", None), ("chunk_id = 12", 1), ("split = 'x'", 1)):
        found = read().filter(asked)
        want = sorted((s, p) for s, c, p, _, _ in rows if eval_filter(asked, s, c, p))
        assert sorted((r["split"], r["start_pos"]) for r in found.collect()) == want, asked
        assert found.rdd.getNumPartitions() <= (n or 4), asked
    for file in (tmp_path / "t").glob("train-*.bin"):
        file.write_bytes(b"broken")
    assert read_ids(read().filter("split = 'val'")) == [7, 8, 9]
    assert read().filter("split = 'train'").rdd.getNumPartitions() >= 8  # planned without opening a shard
    with pytest.raises(Exception, match="not a token file"):
        read().collect()


def eval_filter(asked, split, chunk_id, start_pos):
    """A filter of the test above, in Python."""
    return eval(asked.replace("<>", "!=").replace(" = ", " == ").replace(" AND ", " and ").replace(" IN ", " in "), {}, {"split": split, "chunk_id": chunk_id, "start_pos": start_pos})


def test_windows_cross_chunks(spark):
    source = chunks(spark, list(range(40)), chunk=8)
    offsets = spark.createDataFrame([(0, 0), (1, 5), (2, 31)], "window_id bigint, offset bigint")
    rows = stream.read_windows(source, offsets, 7, 8).collect()
    assert {r["window_id"]: r["tokens"] for r in rows} == {0: [*range(8)], 1: [*range(5, 13)], 2: [*range(31, 39)]}


LOG = """step=    10 | loss=6.0000 [███░░] | lr=3.30e-06 | grad_norm=0.9000 | 655K tok/s | dt=0.30s | tok=2,162,688 | elapsed=3s
step=    20 | loss=5.0000 [███░░] | lr=6.30e-06 | grad_norm=N/A | 655K tok/s | dt=0.30s | tok=4,128,768 | elapsed=12m

============================================================
  EVAL @ step 1,500 | elapsed 1h02m
  Val Loss: 5.2500 | Perplexity: 190.57
  Train Loss (avg last 10): 5.3000
  Best Val Loss: 5.2500
  Tokens Processed: 98,500,608
============================================================

--- Sample generations at step 1500 ---
  PROMPT: A short prompt
  OUTPUT: A short prompt and

its text
  PROMPT: Two
  OUTPUT: Two more

--- End samples ---

step=    10 | loss=4.0000 [███░░] | lr=3.30e-06 | grad_norm=1.2000 | 655K tok/s | dt=0.30s | tok=2,162,688 | elapsed=3s
"""


@pytest.mark.parametrize("split_bytes", ["134217728", "200"])
def test_train_log(spark, tmp_path, split_bytes):
    (tmp_path / "train.log").write_text(LOG)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        lines = trainlog.read_lines(spark, str(tmp_path / "train.log"))
        steps = trainlog.read_steps(lines).orderBy("part", "line").collect()
        evals = trainlog.read_evals(lines).collect()
        samples = trainlog.read_samples(lines).orderBy("sample").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r["run"], r["step"], r["loss"], r["grad_norm"], r["tok"], r["elapsed"]) for r in steps] == [
        (0, 10, 6.0, "0.9000", 2162688, 3), (0, 20, 5.0, "N/A", 4128768, 720), (1, 10, 4.0, "1.2000", 2162688, 3),
    ]
    (e,) = evals
    assert (e["step"], e["val_loss"], e["perplexity"], e["train_loss"], e["best_val_loss"], e["tok"], e["elapsed"]) == (
        1500, 5.25, 190.57, 5.3, 5.25, 98500608, 3720,
    )
    assert [(r["step"], r["sample"], r["prompt"], r["output"]) for r in samples] == [
        (1500, 1, "A short prompt", "A short prompt and\n\nits text"), (1500, 2, "Two", "Two more"),
    ]


STOPPED = """--- Sample generations at step 20 ---
  PROMPT: Open
  OUTPUT: Open
end
step=    30 | loss=4.0000 | lr=3.30e-06
  PROMPT: no sample
--- Sample generations at step 40 ---
  PROMPT: Next
  OUTPUT: Next one
============================================================
  EVAL @ step 40 | elapsed 2m
"""


def test_open_sample_block_ends_at_the_next_line_of_another_kind(spark, tmp_path):
    (tmp_path / "train.log").write_text(STOPPED)
    samples = trainlog.read_samples(trainlog.read_lines(spark, str(tmp_path / "train.log"))).orderBy("step").collect()
    assert [(r["step"], r["sample"], r["prompt"], r["output"]) for r in samples] == [
        (20, 1, "Open", "Open\nend"), (40, 1, "Next", "Next one"),
    ]


def test_samples_and_evaluations_read_the_log_once(spark, tmp_path):
    (tmp_path / "train.log").write_text(LOG)
    lines = trainlog.read_lines(spark, str(tmp_path / "train.log"))
    for table in (trainlog.read_samples(lines), trainlog.read_evals(lines)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= 2  # rows, and the block totals carried to them


def test_corpus_formats_and_ids(spark, tmp_path):
    rows = spark.createDataFrame([("a b", "s1"), ("a b", "s2"), ("c", "s1")], "text string, source string")
    for fmt in ("parquet", "json"):
        rows.write.format(fmt).save(str(tmp_path / fmt))
        read = corpus.read_corpus(spark, str(tmp_path / fmt), fmt, keep=("source",))
        assert read.select("doc_id").distinct().count() == 3
        assert corpus.select_subset(read, "s1").count() == 2 and corpus.select_subset(read, "").count() == 3
    (tmp_path / "plain.txt").write_text("one\ntwo\n")
    assert [r["text"] for r in corpus.read_corpus(spark, str(tmp_path / "plain.txt"), "text").collect()] == ["one", "two"]


def test_materialised_once(spark, tmp_path):
    first = corpus.materialise(spark.range(3).selectExpr("id", "'x' AS text"), str(tmp_path), "part")
    again = corpus.materialise(spark.range(9).selectExpr("id", "'y' AS text"), str(tmp_path), "part")
    assert first.count() == again.count() == 3


def test_prompts(spark):
    assert corpus.prompt_table(spark).count() == 6
    assert corpus.prompt_table(spark, corpus.TRAINING_PROMPTS).count() == 2


def test_example_lines(spark, tmp_path):
    rows = spark.createDataFrame([([1, 2], [0, 1]), ([], [])], tables.EXAMPLE_SCHEMA)
    tables.write_examples(rows, str(tmp_path / "x"))
    lines = [json.loads(x) for f in (tmp_path / "x").glob("*.json") for x in f.read_text().splitlines()]
    assert {"token_ids": [1, 2], "loss_mask": [0, 1]} in lines
    assert tables.read_examples(spark, str(tmp_path / "x"), keep_place=True).select("example_id").distinct().count() == 2


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(5), "check")
    root = shared_folder(spark).removeprefix("file:")
    assert all(root in f for f in staged.inputFiles()) and staged.count() == 5


def test_files_that_arrive_are_encoded(spark, tmp_path, chat_vocab):
    schema = "id int, instruction string, context string, response string"
    source = tmp_path / "in"
    source.mkdir()
    args = (spark, str(source), schema, "dolly", chat_vocab, ["id"], 8, str(tmp_path / "out"), str(tmp_path / "cp"))
    rows = [{"id": 1, "instruction": "a", "context": "", "response": "b"}, {"id": 2, "instruction": "", "response": "b"}]
    for at, row in enumerate(rows + [{"id": 3, "instruction": "c", "context": "d", "response": "e"}]):
        (source / f"{at}.json").write_text(json.dumps(row))
        follow_instructions(*args).awaitTermination()
    got = {r["id"]: (r["x"], r["y"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = instruction_tensors(spark.read.schema(schema).json(str(source)), "dolly", chat_vocab, ["id"], 8)
    assert got == {r["id"]: (r["x"], r["y"]) for r in batch.collect()}
    assert got[1] == ([258, 97, 260, 259, 98, 260, 256, 0], [-1, -1, -1, 98, 260, -1, -1, -1])
    assert set(got) == {1}  # the second is incomplete, the third longer than two sequences
    assert not list(Path(source).glob("_*"))


def test_text_formats_keep_rows(spark, tmp_path):
    rows = spark.createDataFrame([("x,\"y\"\nz",)], "text string")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(str(tmp_path / "c"))
    read = corpus.read_corpus(spark, str(tmp_path / "c"), "csv", schema="text string")
    assert read.select(F.col("text")).first()[0] == "x,\"y\"\nz"


def test_streamed_tensors_equal_the_batch(spark):
    """Two lots, one restart: no row lost, none twice."""
    vocab = vocabulary.extend(vocabulary.byte_vocabulary(spark))
    rows = tb.pairs(spark, SMALL)
    batch = instruction_tensors(rows, "dolly", vocab, ["conv_id", "turn"], tb.SEQ_LENGTH * 2)
    want = sorted((r["conv_id"], r["turn"], ",".join(map(str, r["x"])), ",".join(map(str, r["y"]))) for r in batch.collect())
    assert sorted(map(tuple, queries()["streamed_tensors"](spark, SMALL).collect())) == want and len(want) > 20
