"""Hard negatives against a plain ranking of all rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import negatives


def whole(v, scale=256):
    return [int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in v]


def ranked_all(rows, anchors, k=5, n=10, low=30, high=90):
    """Rows are (id, vector, label); equal rows count once, a null id comes last."""
    good = []
    for row in rows:
        i, v, label = row
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and row not in good:
            good.append(row)
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for i, v, label in good:
        if i is None or not anchors(i):
            continue
        q = whole(v)
        scored = [(r, sum(a * b for a, b in zip(q, whole(r[1])))) for r in good]
        same = sorted(((r[0], s) for r, s in scored if r[2] == label and r != (i, v, label)), key=order)[:k]
        for p, ps in same:
            fits = [(r[0], s) for r, s in scored if r[2] != label and low * ps <= 100 * s <= high * ps]
            for rank, (m, ms) in enumerate(sorted(fits, key=order)[:n], 1):
                out.append((i, p, rank, m, ps, ms))
    return sorted(out, key=str)


def found(spark, rows, block_rows=50, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, block_rows=block_rows, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()), key=str)


def made_up(seed, n, width, coarse=False):
    draw = random.Random(seed)
    near = [draw.gauss(0, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        v = [a + draw.gauss(0, 0.7) for a in near]
        rows.append((i, [round(x) / 4 for x in v] if coarse else v, draw.choice([0, 0, 0, 1, 2])))
    return rows


@pytest.mark.parametrize("coarse,block_rows", [(False, 50), (True, 50), (True, 1000)])
def test_against_all_rows(spark, coarse, block_rows):
    """Coarse vectors tie often; a third and more of the rows have one label."""
    rows = made_up(block_rows, 300, 8, coarse)
    got = found(spark, rows, block_rows)
    assert got == ranked_all(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_odd_rows(spark):
    inf, nan = math.inf, math.nan
    rows = made_up(2, 60, 3, True) + [
        (70, None, 0), (80, [0.1, None, 0.2], 0), (90, [nan, 1.0, 1.0], 0), (100, [inf, 1.0, 1.0], 1), (110, [1.0, 1.0, 1.0], None),
        (None, [0.5, 0.5, 0.5], 1), (None, [0.5, 0.5, 0.25], 0), (120, [], 0), (130, [0.0, 0.0, 0.0], 2), (140, [1.0], 0),
        (150, [1.0, 1.0, 1.0], 0), (150, [1.0, 1.0, 1.0], 0), (150, [0.9, 1.0, 1.0], 0), (151, [0.5, 0.5, 0.5], 1), (151, [0.5, 0.5, 0.5], 1),
        (160, [-1.0, -1.0, -1.0], 7), (170, [1e200, -1e200, 2.0], 8), (171, [1e80, 1.0, 1.0], 8), (172, [3e13, 2e13, 1.0], 9),
    ]
    cut = lambda x: max(-(2**63), min(2**63 - 1, x))
    want = [(*r[:4], cut(r[4]), cut(r[5])) for r in ranked_all(rows, lambda i: i % 10 == 0)]
    assert found(spark, rows) == sorted(want, key=str)
    assert found(spark, [r for r in rows if r[0] is None]) == []
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    clash = df.selectExpr("*", "1 AS key", "'x' AS id", "2 AS block", "3 AS anchor", "4 AS score", "5 AS vector")
    assert negatives.hard_negatives(clash, F.col("vec_id") % 10 == 0).count() == len(want)
    assert negatives.hard_negatives(clash.filter("false"), F.lit(True)).count() == 0


def test_stops_early_and_exactly():
    """Peaked vectors: the lists end the search long before every row is seen."""
    draw = np.random.default_rng(1)
    x = np.floor(draw.normal(size=(4000, 6)) ** 3 * 256)
    lists = negatives.Lists(x)
    q = np.array([900.0, 0, -700, 0, 3, 0])
    best, seen = negatives.Best(5), []

    def visit(rows, scores, threshold):
        seen.append(len(rows))
        rest = np.setdiff1d(np.arange(len(x)), np.concatenate([r for r, *_ in met] + [rows]))
        met.append((rows,))
        assert not len(rest) or (x[rest] @ q).max() <= threshold
        best.offer(rows, scores)
        return best.settled(threshold)

    met = []
    depth = lists.search(q, visit)
    scores = x @ q
    assert best.rows.tolist() == np.lexsort((np.arange(len(x)), -scores))[:5].tolist()
    assert sum(seen) < len(x) and depth < len(x)


def test_components():
    v = pa.array([[0.5, -0.001], [], [1.0]], pa.list_(pa.float32()))
    assert negatives.components(v, 256).tolist() == [[128, -1], [0, 0], [256, 0]]
    assert negatives.components(v[1:2], 256).shape == (1, 0)
