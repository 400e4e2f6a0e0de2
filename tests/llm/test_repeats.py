"""Repeated windows: exact however the texts are dealt."""

import random

import numpy as np
import pytest
from helpers import kept_bytes
from pyspark.sql import functions as F

from corpusloom.llm import repeats

SMALL = "/root/testdata/sf0.001"


def test_windows_of_different_bytes_before_the_anchor():
    """150 different suffixes; byte e before one and a space before another make no equal windows."""
    block = [(bytes([i, 7]) * 200, b"") for i in range(150)]
    block[32] = (block[32][0], b"e")
    block[101] = (block[101][0], b" ")
    found = repeats._equal_windows(block, np.zeros(150, np.int64), 400)
    assert not found.any()


def test_windows_equal_to_brute_force():
    draw = random.Random(4)
    for _ in range(40):
        n, length = 30, 8
        block = sorted((bytes(draw.choice(b"ab") for _ in range(draw.randint(6, 9))), bytes(draw.choice(b"xy") for _ in range(draw.randint(0, 4)))) for _ in range(n))
        shared = [0]
        for (a, _), (b, _) in zip(block, block[1:]):
            shared.append(next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))))
        found = repeats._equal_windows(block, np.array(shared), length)
        for d in range(found.shape[1]):
            windows = [left[len(left) - d :] + s[: length - d] if len(left) >= d and len(s) >= length - d else None for s, left in block]
            assert [w is not None and windows.count(w) > 1 for w in windows] == found[:, d].tolist()


def planted(spark):
    """The smallest table with a random passage in every tenth text, some of them twice."""
    draw = random.Random(8)
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    some = lambda n: " ".join("".join(draw.choice("abcdefgh é") for _ in range(6)) for _ in range(n))
    passages = [some(70) for _ in range(8)]
    out = []
    for i, text in rows:
        if i % 10 == 0:
            at = draw.randint(0, len(text))
            text = text[:at] + (draw.choice(passages) if draw.random() < 0.6 else some(80)) + text[at:]
        out.append((i, text))
    return out


@pytest.mark.parametrize("parts", [3, 16, 211])
def test_dealt_over_many_tasks(spark, parts, monkeypatch):
    monkeypatch.setattr(repeats, "RANGE_BYTES", 20_000)
    texts = planted(spark)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(parts)
    got = {r["doc_id"]: bytes(r["removed"]["kept"]) for r in repeats.with_removed(docs).collect()}
    assert [got[i] for i, _ in texts] == kept_bytes([t for _, t in texts])


def test_ranges_keep_anchors_together_and_split_a_common_beginning():
    draw = np.random.default_rng(1)
    anchors = draw.integers(0, 2**63, 10_000).astype(np.uint64)
    leads = np.where(draw.random(10_000) < 0.7, 5, draw.integers(-100, 100, 10_000))
    cuts = np.sort(np.quantile(leads, np.arange(1, 10) / 10).astype(np.int64))
    parts = repeats.parts_of(leads, anchors, cuts)
    assert np.bincount(parts).max() < 2000 and (parts == repeats.parts_of(leads, anchors, cuts)).all()
    order = np.argsort(parts, kind="stable")
    ends = [leads[parts == p] for p in np.unique(parts)]
    assert all(a.max() <= b.min() for a, b in zip(ends, ends[1:])) and len(order) == 10_000


def test_shorter_passages(spark):
    """The length is a parameter; a text longer than a chunk is cut too."""
    passage = "".join(random.Random(3).choice("abcdefg ") for _ in range(260))
    texts = ["x" + passage + "y", "q " * 200_000 + passage, passage[:249], "é" * 10]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = repeats.without_repeats(docs.withColumn("n_chars", F.length("text")), length=250)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got[0] == ("xy", 2) and got[2] == (texts[2], 249) and got[3] == (texts[3], 10)
    assert kept_bytes(texts[:1] + [texts[1][-600:]] + texts[2:], 250)[0] == b"xy" and got[1][1] < 250
