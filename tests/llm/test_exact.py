"""Operators with one right answer, against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import contamination as brute_contamination
from helpers import jaccard_classes, kept_bytes, mixed, words

from corpusloom.llm import contamination, fixity, imatch, jaccard, licenses, mixing, repeats, suffixes
from corpusloom.llm.components import components


def made_up(seed, n, alphabet="abcdé ", pieces=6):
    """Texts put together from common pieces and noise."""
    draw = random.Random(seed)
    pool = ["".join(draw.choice(alphabet) for _ in range(200)) for _ in range(pieces)]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(draw.randint(0, 5)):
            a = draw.randint(0, 150)
            text += draw.choice(pool)[a : a + draw.randint(5, 90)] + "".join(draw.choice("abxyz ") for _ in range(draw.randint(0, 25)))
        out.append(text)
    return out + ["a" * 45, None, "", out[3], out[3], "q" * 19]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_contamination(spark, broadcast_bytes):
    draw = random.Random(1)
    vocabulary = "the of and to a in is Stop stop über x9".split()
    item = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(1, item(30)), (2, item(14)), (3, item(7)), (4, "x9 über"), (5, ""), (6, None), (7, item(10)), (7, item(11))]
    texts = []
    for _ in range(80):
        words = item(draw.randint(0, 40)).split()
        source = (draw.choice(items)[1] or "").split()
        a = draw.randint(0, max(0, len(source) - 3))
        at = draw.randint(0, len(words))
        texts.append(", ".join(words[:at] + source[a : a + draw.randint(5, 20)] + words[at:]))
    texts += [None, "", texts[0]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = contamination.with_contamination(table(spark, texts), bench, broadcast_bytes=broadcast_bytes)
    got = {r["doc_id"]: r["found"] for r in found.collect()}
    for i, text in enumerate(texts):
        n, hit, names = brute_contamination(text, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (n, hit, names)
        assert sum(s["end"] - s["begin"] for s in got[i]["spans"]) == hit


def test_large_benchmark_of_common_words(spark):
    """Texts and items of the same words: what is joined are shared windows, not words."""
    draw = random.Random(11)
    common = [f"w{i}" for i in range(60)]
    some = lambda n: [draw.choice(common) for _ in range(n)]
    opening = some(10)  # of every third item, and of some texts
    items = [(i, " ".join((opening if i % 3 == 0 else []) + some(40))) for i in range(300)] + [(900, "w1 w2 w3"), (901, "w7")]
    texts = [" ".join(some(60) + (opening if i % 4 == 0 else []) + (items[i][1].split()[5:20] if i % 5 == 0 else [])) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = contamination.with_contamination(table(spark, texts), bench, broadcast_bytes=0)
    assert "item_text" not in found._jdf.queryExecution().optimizedPlan().toString()  # texts do not meet items
    got = {r["doc_id"]: r["found"] for r in found.collect()}
    small = contamination.with_contamination(table(spark, texts), bench)
    assert got == {r["doc_id"]: r["found"] for r in small.collect()}
    for i in range(0, 300, 20):
        n, hit, names = brute_contamination(texts[i], items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == (n, hit, names)


@pytest.mark.parametrize("cluster", [100_000, 2])
def test_repeats(spark, cluster):
    texts = made_up(2, 60)
    cut = repeats.with_removed(table(spark, texts), length=20, gram=12, cluster=cluster)
    got = {r["doc_id"]: bytes(r["removed"]["kept"]) for r in cut.collect()}
    assert [got[i] for i in range(len(texts))] == kept_bytes(texts, 20)


def test_repeats_at_full_length(spark):
    draw = random.Random(7)
    noise = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    passage = noise(1000)
    texts = [noise(700) + passage[draw.randint(0, 300) : draw.randint(600, 1000)] + noise(600) for _ in range(30)]
    texts += [passage[:399], passage[:400], noise(5000), "ab" * 600, texts[0][:900]]
    got = {r["doc_id"]: bytes(r["removed"]["kept"]) for r in repeats.with_removed(table(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == kept_bytes(texts)


def test_merge_of_runs():
    draw = random.Random(3)
    for _ in range(100):
        runs, every = [], []
        for run in range(draw.randint(0, 7)):
            records = [(bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 9))), b"", run, i) for i in range(draw.randint(0, 20))]
            every += records
            runs.append(suffixes.decoded(suffixes.front_coded(records)))
        got = list(suffixes.merged(runs))
        assert sorted(r for _, r in got) == sorted(every)
        before = b""
        for shared, record in got:
            assert before <= record[0] and shared == suffixes.common(before, record[0])
            before = record[0]


def near_copies(seed, n_base=25):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(3))
    texts = []
    for _ in range(n_base):
        base = [word() for _ in range(draw.randint(1, 120))]
        for _ in range(draw.randint(1, 6)):
            copy = list(base)
            for _ in range(draw.randint(0, 3)):
                copy[draw.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    return texts + [None, "", "?!", texts[0], texts[0].upper(), "a b", "a b", "b a"]


@pytest.mark.parametrize("block", [512, 2])
def test_jaccard(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block)
    texts = near_copies(4)
    rows = {r["doc_id"]: r for r in jaccard.classes(table(spark, texts)).collect()}
    classes, degree = jaccard_classes(texts)
    assert [rows[i]["class_id"] for i in range(len(texts))] == classes
    assert [rows[i]["n_links"] for i in range(len(texts))] == degree
    kept = jaccard.one_per_class(table(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(classes))


def test_depth_reaches_recall():
    depth = jaccard.depth_for(0.8, 0.9999, 24)
    assert 1 - (1 - 0.8**depth) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (depth + 1)) ** 24


def test_components(spark):
    draw = random.Random(5)
    pairs = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "node int, root int")).collect()}
    parent = {x: x for pair in pairs for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {x: got.get(x, x) for x in parent} == {x: find(x) for x in parent}


def test_targets_and_sizes_of_the_mix(spark):
    draw = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(draw.randint(0, 30))), draw.choice(["a", "b", "c", "d", "ä", None, "e"])) for i in range(600)]
    rows += [(1000, "rare rare", "zz"), (1001, None, "zz"), (1002, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.with_copies(docs).select("source", "mix.*").collect()
    targets, sizes = mixed([(s, t) for _, t, s in rows])
    taken = dict.fromkeys(targets, 0)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    assert all(abs(taken[s] - targets[s]) <= 30 for s in targets)
    again = mixing.with_copies(docs.repartition(7)).select("source", "mix.*").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_repeats_the_whole_copies(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a") for i in range(40)] + [(99, "w " * 20, "b")], "doc_id bigint, text string, source string")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(docs).collect()}
    assert copies[99] == 3 and sum(copies.values()) == 3 + 36  # of 420 words, b takes 60 and a the rest


def test_weighted_mix_by_brute_force(spark):
    draw = random.Random(7)
    rows = [(i, "w " * draw.randint(1, 9), draw.choice("ab"), draw.choice([0.5, 1.0, 2.0, 9.0, 400.0])) for i in range(800)]
    rows += [(2000, "w w", "a", None), (2001, "w w", "a", -1.0), (2002, "w", "b", float("nan")), (2003, None, "a", 5.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, share double")
    got = {r["doc_id"]: r for r in mixing.with_copies(docs, weight="share").select("doc_id", "source", "mix.*").collect()}
    keyed = docs.select("doc_id", mixing._row_key("doc_id", "text", mixing.SEED).alias("u")).collect()
    u = {r["doc_id"]: r["u"] for r in keyed}
    for source in "ab":
        mine = [(i, len((t or "").split()), w) for i, t, s, w in rows if s == source]
        size, target = got[mine[0][0]]["source_size"], got[mine[0][0]]["target"]
        whole = int(target // size)
        rest = target - whole * size
        live = [(i, n, w) for i, n, w in mine if n and w and w > 0]
        certain = set()
        while True:
            level = (rest - sum(n for i, n, _ in live if i in certain)) / sum(n * w for i, n, w in live if i not in certain)
            more = {i for i, _, w in live if i in certain or level * w >= 1}
            if more == certain:
                break
            certain = more
        odds = {i: 0.0 if i in certain else u[i] / (1 - u[i]) / (level * w / (1 - level * w)) for i, _, w in live}
        taken, run = set(), 0
        for order in sorted(set(odds.values())):
            group = [(i, n) for i, n, _ in live if odds[i] == order]
            words_of = sum(n for _, n in group)
            if abs(run + words_of - rest) >= abs(run - rest):
                break
            run += words_of
            taken |= {i for i, _ in group}
        assert source == "b" or certain  # some of the heaviest are certain
        assert {i for i, n, _ in mine if n and got[i]["copies"] == whole + 1} == taken
        assert all(got[i]["copies"] == whole for i, n, _ in mine if n and i not in taken)
        assert abs(run - rest) <= 5


def test_a_mix_with_too_few_weighted_words_takes_them_all(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a", float(i == 0)) for i in range(20)] + [(99, "w " * 100, "b", 1.0)], "doc_id bigint, text string, source string, share double")
    copies = {r["doc_id"]: r["mix"]["copies"] for r in mixing.with_copies(docs, weight="share").collect()}
    whole = copies[1]
    assert copies[0] == whole + 1 and {copies[i] for i in range(1, 20)} == {whole}


def test_edited_texts_and_equal_fingerprints(spark):
    texts = ["abcdefgh", "", None, "xyz" * 50, "xyz" * 50, "one two three four five six", "日本語テキスト"]
    docs = table(spark, texts)
    rows = imatch.with_neighbours(docs, imatch.learn_lexicon(docs)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        a, b = text or "", texts[(i + 1) % len(texts)] or ""
        n = len(a) // 4
        assert got[i]["edited_text"].decode() == a[: len(a) - n] + b[:n]
        assert got[i]["n_chars"] == len(a)
    assert got[3]["fingerprint"] == got[4]["fingerprint"] and got[3]["near_next"] == 1
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_edited"] == 1


def _scrambled(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


MASK = 2**64 - 1


def _hashed(data):
    return _scrambled(sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 2**64) for i, b in enumerate(data)) & MASK)


def _signed(text, lexicon):
    """Signatures of one text, a subset at a time, from sets of words."""
    shift = 64 - imatch.TERM_BITS
    terms = {_hashed(w.encode()) >> shift for w in words(text)}
    terms = (terms & lexicon) or terms or {_hashed(text.encode())}
    out = []
    for j, rate in enumerate(imatch.RATES.tolist()):
        factor = _scrambled((imatch.SEED << 32) + j + 1) | 1
        places = [_scrambled(t + 1) * factor & MASK for t in sorted(terms)]
        places = [p for p in places if p < 2 ** (64 - rate)]
        listed = sum(_scrambled((p + i * 0xD6E8FEB86659FD93) & MASK) for i, p in enumerate(places)) & MASK
        out.append(max(_scrambled(listed) >> 48, 1) if places else 0)
    return out


def test_fingerprints_and_likeness_by_brute_force(spark):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(pool, k=rng.choice([1, 3, 40, 300]))) for _ in range(60)] + ["", "!?", None, "only here"]
    rows = imatch.with_neighbours(table(spark, texts), imatch.learn_lexicon(table(spark, texts))).collect()
    held = Counter(_hashed(w.encode()) >> (64 - imatch.TERM_BITS) for t in texts for w in set(words(t)))
    low, high = len(texts) * math.exp(-imatch.MAX_IDF), len(texts) * math.exp(-imatch.MIN_IDF)
    lexicon = {t for t, n in held.items() if low <= n <= high}
    assert 0 < len(lexicon) < len(held)
    plain = [t or "" for t in texts]

    def like(a, b):
        near = [x == y for x, y in zip(a, b, strict=True) if x or y][: imatch.NEAREST]
        return sum(near) / len(near)

    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        following = plain[(i + 1) % len(plain)]
        own, other = _signed(plain[i], lexicon), _signed(imatch.edited(plain[i], following), lexicon)
        assert r["fingerprint"] == "".join(f"{x:04x}" for x in own)
        assert r["edited_fingerprint"] == "".join(f"{x:04x}" for x in other)
        assert r["near_edited"] == pytest.approx(like(own, other))
        assert r["near_next"] == pytest.approx(like(own, _signed(following, lexicon)))


def test_order_across_buckets(spark):
    docs = spark.range(3000).selectExpr("id * 7 AS doc_id", "concat('text number ', id, ' of many') AS text").repartition(5)
    rows = imatch.with_neighbours(docs, imatch.learn_lexicon(docs)).collect()
    assert len(rows) == 3000
    for r in rows:
        k = r["doc_id"] // 7
        assert r["edited_text"].decode() == imatch.edited(f"text number {k} of many", f"text number {(k + 1) % 3000} of many")


def test_licenses(spark):
    texts = [
        "Code. Released under the MIT License. More.",
        "released, under the mit licence",
        "x " * 31 + "Licensed under the Apache License, Version 2.0.",
        "Permission is hereby granted, free of charge, to any individual obtaining a copy of this software",
        "the license of a dog",
        None,
        "",
    ]
    got = [[x["name"] for x in r["licenses"]] for r in licenses.with_licenses(table(spark, texts)).orderBy("doc_id").collect()]
    assert got == [["MIT"], [], ["Apache-2.0"], ["MIT notice"], [], [], []]


def test_short_license_templates(spark):
    notices = [f"{'w ' * k}All rights reserved. {'v ' * j}" for k in range(6) for j in range(6)]
    others = ["all rights are reserved", "all rights of mine, rights reserved", "rights reserved all", "", None]
    docs = table(spark, notices + others)
    got = [[(x["name"], x["containment"]) for x in r["licenses"]] for r in licenses.with_licenses(docs).orderBy("doc_id").collect()]
    assert got == [[("All rights reserved", 1.0)]] * 36 + [[]] * 5
    many = licenses.with_licenses(docs, templates={f"t{i}": f"{'v ' * i}reserved v" for i in range(3)}).count()
    assert many == 41


def test_fixity_of_empty_and_repeated_records(spark):
    ours = spark.createDataFrame([(1, b""), (2, b"abc"), (3, b"x"), (4, None)], "record_id bigint, content binary")
    theirs = spark.createDataFrame([(2, b""), (3, b"x"), (4, b"")], "record_id bigint, content binary")
    got = {r["record_id"]: r["status"] for r in fixity.damaged(ours, theirs).collect()}
    assert got == {1: "missing", 2: "changed"}
    hot = spark.range(5000).selectExpr("7 AS record_id", "cast(id % 3 AS string) AS content")
    hot = hot.selectExpr("record_id", "cast(content AS binary) AS content")
    assert fixity.damaged(hot, hot.repartition(5)).count() == 0
    assert [r["status"] for r in fixity.damaged(hot, hot.limit(4999)).collect()] == ["changed"]


def test_fixity(spark):
    ours = spark.range(9000).selectExpr("id AS record_id", "cast(concat('record ', id) AS binary) AS content")
    theirs = ours.filter("record_id <> 4097").unionByName(spark.createDataFrame([(20000, b"new")], "record_id bigint, content binary"))
    theirs = theirs.selectExpr("record_id", "if(record_id in (0, 8999), cast('rot' AS binary), content) AS content")
    got = {r["record_id"]: (r["status"], r["begin"]) for r in fixity.damaged(ours, theirs).collect()}
    begin = sum(len(f"record {i}") for i in range(8192, 8999))
    assert got == {0: ("changed", 0), 4097: ("missing", len("record 4096")), 8999: ("changed", begin), 20000: ("extra", None)}
    assert fixity.damaged(ours, ours).count() == 0
    assert fixity.damaged(ours.filter("false"), ours.filter("false")).count() == 0


@pytest.mark.parametrize("block", [4096, 3])
def test_crowd_falls_apart_before_it_is_verified(spark, monkeypatch, block):
    """Texts of likeness 0.5 to each other, some with a near copy: only those are linked."""
    monkeypatch.setattr(jaccard, "BLOCK_PATHS", block)
    draw = random.Random(11)
    common = [f"c{i}" for i in range(84)]
    texts = []
    for i in range(150):
        own = common + [f"o{i}x{j}" for j in range(40)]
        texts.append(" ".join(own))
        if i % 10 == 0:
            own[100] = "changed"
            texts.append(" ".join(own))
    draw.shuffle(texts)
    seen = []
    verified = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda links, name="links": (seen.append(verified(links, name)), seen[-1])[1])
    rows = {r["doc_id"]: r for r in jaccard.classes(table(spark, texts)).collect()}
    classes, degree = jaccard_classes(texts)
    assert [rows[i]["class_id"] for i in range(len(texts))] == classes
    assert [rows[i]["n_links"] for i in range(len(texts))] == degree
    assert [found.count() for found in seen[-2:]] == [15, 15]  # candidates by signature, verified classes


def test_signature_components():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 256, (4, 576), dtype=np.uint8)
    rows = []
    for i in range(40):
        row = base[i % 4].copy()
        row[draw.choice(576, 60, replace=False)] = draw.integers(0, 256, 60)
        rows.append(row)
    assert jaccard.connected(np.array(rows), 0.8).tolist() == [i % 4 for i in range(40)]
    assert jaccard.connected(np.zeros((0, 576), np.uint8), 0.8).tolist() == []
