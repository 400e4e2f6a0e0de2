"""Tokenisation against independent implementations."""

import base64
import hashlib
import json
import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from conftest import SMALL
from pyspark.sql import functions as F

from __spark_entry__ import queries
from corpusloom.functions.text import SUBWORD_SPLIT, pieces
from corpusloom.operators import bpe, rankfile, tokenize, vocabulary

PUBLISHED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ODD_TEXTS = [
    "", " ", "a  b", "tabs\t\tand\n\n lines \n", "no break  space　x", "it's we'll I'VE 'tis",
    "12ab 3.5%  —“q”", "naïve Größe école 日本語テキスト", "\U0001f600 emoji\U0001f44d\U0001f3fd", "a" * 3000 + " " * 50,
]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")


def test_split_equals_published_pattern(spark):
    texts = ODD_TEXTS + [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = table(spark, texts).select("doc_id", pieces(F.col("text")).alias("p")).collect()
    for row in rows:
        assert row["p"] == regex.findall(PUBLISHED, texts[row["doc_id"]])


def slow_merges(texts, n):
    """Byte-pair learning one merge at a time."""
    words = Counter(p for t in texts for p in regex.findall(PUBLISHED, t))
    coded = {w: list(w.encode()) for w in words}
    merges = []
    while len(merges) < n:
        pairs = Counter()
        for w, c in words.items():
            for pair in zip(coded[w], coded[w][1:]):
                pairs[pair] += c
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append(best)
        new = 255 + len(merges)
        for w, ids in coded.items():
            out, i = [], 0
            while i < len(ids):
                if tuple(ids[i : i + 2]) == best:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            coded[w] = out
    return merges


@pytest.mark.parametrize(
    "texts, n",
    [
        (["aaa aaaa aaaaa aa", "abab ababab baba", "zzzz"], 12),
        (["the cat sat on the mat, the bat", "that hat is a flat hat", "naïve naïveté"], 40),
    ],
)
def test_learning_equals_one_at_a_time(spark, texts, n):
    merges, _ = bpe.learn_merges(table(spark, texts), n)
    assert merges == slow_merges(texts, n)


def test_learning_on_documents_equals_one_at_a_time(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    merges, words = bpe.learn_merges(docs, 48)
    assert merges == slow_merges([r["text"] for r in docs.collect()], 48)


@pytest.mark.parametrize("look_ahead,most", [(1, 1), (3, 200_000), (40, 60), (5_000, 200_000)])
def test_merges_do_not_depend_on_how_many_are_looked_at(spark, look_ahead, most):
    draw = random.Random(look_ahead)
    texts = ["".join(draw.choice(["a", "aa", "ab", "ba", "aba", " b", "c", "é", " "]) for _ in range(draw.randint(0, 40))) for _ in range(60)]
    merges, _ = bpe.learn_merges(table(spark, texts), 25, look_ahead=look_ahead, most=most)
    assert merges == slow_merges(texts, 25)


def test_segments_and_their_merges():
    assert list(bpe.segments_of("abcabd", {"ab", "bc"})) == ["abc", "ab"]
    assert list(bpe.segments_of("", {"ab"})) == [] == list(bpe.segments_of("a", {"ab"}))
    assert bpe.continued_merges([([1, 1, 1], 5), ([1, 2], 4)], 0, 9, 300) == [(1, 1), (300, 1), (1, 2)]
    assert bpe.continued_merges([([1, 1, 1], 5), ([1, 2], 4)], 7, 9, 300) == [(1, 1)]
    assert bpe.continued_merges([([1, 2], 4), ([3, 4], 4)], 4, 9, 300) == [(1, 2)]



def test_encoding_equals_tiktoken(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    vocab = bpe.learn_vocabulary(docs, 60)
    ranks = {bytes(r["token"]): r["token_id"] for r in vocab.table.filter("NOT is_special").collect()}
    independent = tiktoken.Encoding("own", pat_str=PUBLISHED, mergeable_ranks=ranks, special_tokens=vocab.specials)
    texts = [r["text"] for r in docs.collect()] + ODD_TEXTS + ["a<|endoftext|> b  <|endoftext|>"]
    for row in tokenize.tokenize(table(spark, texts), vocab).collect():
        assert row["token_ids"] == independent.encode(texts[row["doc_id"]], allowed_special="all")


def test_encoding_with_a_vocabulary_too_large_to_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    vocab = bpe.learn_vocabulary(docs, 60)
    rows = table(spark, ODD_TEXTS + ["a<|endoftext|> b", None, "", "abc " * 5_000]).unionByName(docs.limit(50))
    want = tokenize.tokenize(rows, vocab).collect()
    monkeypatch.setattr(vocabulary, "BROADCAST_ROWS", 10)
    assert not vocab.broadcastable
    assert tokenize.tokenize(rows, vocab).collect() == want


def test_tokens_of_equal_hash_are_told_apart(tmp_path, monkeypatch):
    key = hashlib.md5(b"ab").digest()[: rankfile.KEY_BYTES]
    held = pa.table({"key": [key] * 3, "token_id": [4, 5, 6], "token": [b"x", b"ab", b""]})
    pq.write_table(held, tmp_path / "part-0")
    pq.write_table(held.slice(0, 0), tmp_path / "part-1")
    monkeypatch.setattr(rankfile.SparkFiles, "getRootDirectory", lambda: str(tmp_path))
    for _ in range(2):  # laid out, then found
        ranks = rankfile.RankFile(["part-0", "part-1"])
        assert (ranks[b"ab"], ranks.get(b"y", 9), b"abc" in ranks, len(ranks)) == (5, 9, False, 3)
        monkeypatch.setattr(rankfile, "MEMO_RANKS", 0)
    assert rankfile.RankFile(["part-1"]).get(b"ab") is None


def test_null_and_empty_texts(spark, chat_vocab):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a<|user|>")], "doc_id int, text string")
    want = {1: [], 2: [], 3: [97, 258]}
    assert {r["doc_id"]: r["token_ids"] for r in tokenize.tokenize(rows, chat_vocab).collect()} == want
    looked_up = tokenize.tokenize_by_lookup(rows, chat_vocab, ["doc_id"])
    assert {r["doc_id"]: r["token_ids"] for r in looked_up.collect()} == want
    plain = tokenize.tokenize_by_lookup(rows, chat_vocab, ["doc_id"], allow_special=False)
    assert {r["doc_id"]: r["token_ids"] for r in plain.collect()}[3] == list(b"a<|user|>")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_round_trip(spark, chat_vocab, texts):
    rows = table(spark, texts)
    for coded in (
        tokenize.tokenize(rows, chat_vocab, allow_special=False),
        tokenize.tokenize_by_lookup(rows, chat_vocab, ["doc_id"], allow_special=False),
        tokenize.byte_tokenize(rows),
    ):
        back = tokenize.detokenize(coded, chat_vocab, ["doc_id"]).collect()
        assert {r["doc_id"]: r["text"] for r in back} == dict(enumerate(texts))


def test_malformed_bytes_become_replacement_characters(spark, chat_vocab):
    raw = b"A\xe2\x82\xffB\xf0\x9f\x98"
    rows = spark.createDataFrame([(1, list(raw))], "doc_id int, token_ids array<int>")
    text = tokenize.detokenize(rows, chat_vocab, ["doc_id"]).first()["text"]
    assert text == raw.decode("utf-8", "replace")


def test_vocabulary_files(spark, tmp_path):
    spelled = {v: k for k, v in vocabulary.printable_byte_alphabet().items()}
    assert len(spelled) == 256 and spelled["20"] == "Ġ" and spelled["0A"] == "Ċ"
    tokens = [bytes([b]) for b in range(256)] + [b" t", b" th", "é".encode()]
    entries = {"".join(spelled[f"{b:02X}"] for b in t): i for i, t in enumerate(tokens)}
    (tmp_path / "vocab.json").write_text(json.dumps(entries | {"<|endoftext|>": len(tokens)}))
    lines = "".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens))
    (tmp_path / "ranks.txt").write_text(lines)
    for name, layout in (("vocab.json", "json"), ("ranks.txt", "ranks")):
        vocab = vocabulary.read_vocab(spark, str(tmp_path / name), layout, len(tokens) + 1)
        found = {r["token_id"]: bytes(r["token"]) for r in vocab.table.collect()}
        assert found == dict(enumerate([*tokens, b"<|endoftext|>"]))
        ids = tokenize.tokenize(table(spark, [" thé"]), vocab).first()["token_ids"]
        assert ids == [257, 258]
    for size in (len(tokens), len(tokens) - 1):
        with pytest.raises(ValueError, match="do not fit"):
            vocabulary.read_vocab(spark, str(tmp_path / "ranks.txt"), "ranks", size)
    assert vocabulary.extend(vocab).special("end_turn") == vocab.size + 3
    assert SUBWORD_SPLIT == vocab.pattern


def test_a_thousand_merges_on_a_small_table(spark, tmp_path):
    """The registered query against learning one at a time."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("length(text) < 400").orderBy("doc_id").limit(25)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    made = queries()["learned_vocabulary"](spark, str(tmp_path)).filter("token_id >= 256 AND NOT is_special").orderBy("token_id").collect()
    merges = slow_merges([r["text"] for r in docs.collect()], 1000)
    tokens = [bytes([b]) for b in range(256)]
    for left, right in merges:
        tokens.append(tokens[left] + tokens[right])
    assert [bytes.fromhex(r["token"]) for r in made] == tokens[256:]
