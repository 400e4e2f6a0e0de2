"""Byte-pair encoding: learn merges over piece counts, encode pieces with a vocabulary.

While learning, a piece is a string with one character per token, where token ``i`` is
spelled by code point ``i`` (stepping over the surrogates). A pair is then a two-character
substring, counted by Spark's own string functions, and a merge a plain string replacement.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import END_OF_TEXT, SUBWORD_SPLIT, latin
from corpusloom.operators.lookup import row_slices
from corpusloom.operators.rankfile import RankFile, opened, publish
from corpusloom.operators.vocabulary import N_BYTES, Vocabulary, byte_rows, count_pieces, special_rows
from corpusloom.session import stage, task_count

SURROGATES = (0xD800, 0xE000)
LOOK_AHEAD = 2_048  # pairs of a round whose merges are looked through at once
SEGMENTS = 200_000  # different stretches of such pairs on the driver at most
SHORT_PIECE = 48  # bytes; longer pieces are merged with a queue
MEMO_PIECES = 100_000  # pieces remembered by one Python worker, and those of one slice
SLICE_PIECES = 1 << 17  # pieces encoded, or ids spelled, at a time; a longer text is a slice of its own


def spelling(token_id: int) -> str:
    first, last = SURROGATES
    return chr(token_id if token_id < first else token_id + last - first)


def token_of(character: str) -> int:
    first, last = SURROGATES
    point = ord(character)
    return point if point < first else point - (last - first)


def _pair_counts(words: DataFrame) -> DataFrame:
    """Occurrences of each adjacent pair, weighted by how often the word occurs."""
    length = F.char_length("word")
    return (
        words.filter(length > 1)
        .select(
            F.explode(
                F.transform(F.sequence(F.lit(1), length - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
            ).alias("pair"),
            "n",
        )
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )


def segments_of(word: str, pairs: set[str]) -> Iterator[str]:
    """The longest stretches of a word in which every two neighbours are one of ``pairs``."""
    begin = 0
    for i in range(1, len(word) + 1):
        if i == len(word) or word[i - 1 : i + 1] not in pairs:
            if i - begin > 1:
                yield word[begin:i]
            begin = i


def _segment_counts(words: DataFrame, pairs: list[str]) -> DataFrame:
    """``(segment, n)``; the parts of words that merges of ``pairs`` can change."""
    known = set(pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, int] = {}
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for segment in segments_of(word, known):
                    found[segment] = found.get(segment, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["segment", "n"])

    counted = words.select("word", F.col("n").cast("bigint").alias("n")).mapInArrow(run, "segment string, n bigint")
    return counted.groupBy("segment").agg(F.sum("n").alias("n"))


def continued_merges(segments: list[tuple[list[int], int]], limit: int, room: int, next_id: int) -> list[tuple[int, int]]:
    """One-at-a-time merges of counted token sequences, as long as the best pair occurs more than ``limit`` times.

    The first merge is taken in any case. An index from pairs to the sequences that hold them gives
    each merge its few sequences, and the counts change by what changes there.
    """
    counts: dict[tuple[int, int], int] = {}
    holders: dict[tuple[int, int], set[int]] = {}
    for at, (ids, n) in enumerate(segments):
        for pair in zip(ids, ids[1:]):
            counts[pair] = counts.get(pair, 0) + n
            holders.setdefault(pair, set()).add(at)
    queue = [(-n, *pair) for pair, n in counts.items()]
    heapq.heapify(queue)
    taken: list[tuple[int, int]] = []
    while queue and len(taken) < room:
        n, left, right = heapq.heappop(queue)
        pair = (left, right)
        if counts.get(pair, 0) != -n:
            continue  # an older count
        if taken and -n <= limit:
            break
        taken.append(pair)
        changed: dict[tuple[int, int], int] = {}
        for at in holders.pop(pair):
            ids, times = segments[at]
            for old in zip(ids, ids[1:]):
                changed[old] = changed.get(old, 0) - times
            ids = _joined(ids, left, right, next_id)
            segments[at] = ids, times
            for new in zip(ids, ids[1:]):
                changed[new] = changed.get(new, 0) + times
                if next_id in new:
                    holders.setdefault(new, set()).add(at)
        for other, by in changed.items():
            if by:
                counts[other] = counts.get(other, 0) + by
                if counts[other] > 0:
                    heapq.heappush(queue, (-counts[other], *other))
        counts.pop(pair, None)
        next_id += 1
        if -n <= limit:
            break
    return taken


def _joined(ids: list[int], left: int, right: int, new: int) -> list[int]:
    out, i = [], 0
    while i < len(ids):
        if i + 1 < len(ids) and ids[i] == left and ids[i + 1] == right:
            out.append(new)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return out


def _with_merges(words: DataFrame, merges: list[tuple[int, int]], next_id: int) -> DataFrame:
    """The words after the merges, in order."""
    steps = [(spelling(a) + spelling(b), spelling(next_id + i)) for i, (a, b) in enumerate(merges)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                for pair, token in steps:
                    if len(word) < 2:
                        break
                    word = word.replace(pair, token)
                out.append(word)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(1)], ["word", "n"])

    return words.select("word", "n").mapInArrow(run, words.select("word", "n").schema)


def learn_merges(
    df: DataFrame, n_merges: int, text: str = "text", pattern: str = SUBWORD_SPLIT, look_ahead: int = LOOK_AHEAD, most: int = SEGMENTS
) -> tuple[list[tuple[int, int]], DataFrame]:
    """Learn merges by pair frequency; ties go to the smaller (left, right) ids.

    Returns the merges in order (token ``256 + i`` is merge ``i``) and the word table with
    each word's encoding.

    A round counts all pairs and looks at the ``look_ahead`` best. Merges among them only
    touch stretches of such pairs: a pair that a merge creates occurs no more often than the
    pair at its seam, so any pair off the list, or made from one, occurs at most as often as the
    best one left off. The counted stretches, equal ones together, are merged on the driver as
    long as the best pair beats that, which is exactly what one-at-a-time learning would do; then
    all words are rewritten once. If there are more than ``most`` stretches, fewer
    pairs are looked at; one pair has few, so every size works, with more rounds.
    """
    words = count_pieces(df, text, pattern).select(latin(F.col("piece")).alias("word"), F.col("n").cast("bigint").alias("n"))
    # Spread evenly: the work per round is in the processor, not in the few bytes.
    words = stage(words.repartition(task_count(df.sparkSession)), "bpe-words")
    merges: list[tuple[int, int]] = []
    ahead = look_ahead
    while len(merges) < n_merges:
        order = (F.desc("n"), F.substring("pair", 1, 1), F.substring("pair", 2, 1))
        best = [(r["pair"], r["n"]) for r in _pair_counts(words).orderBy(*order).limit(look_ahead + 1).collect()]
        if not best:
            break
        while True:
            pairs = [pair for pair, _ in best[:ahead]]
            found = _segment_counts(words, pairs).limit(most + 1).collect()
            if len(found) <= most or ahead == 1:
                break
            ahead = max(1, ahead // 4)
        limit = best[ahead][1] if ahead < len(best) else 0
        segments = [([token_of(c) for c in r["segment"]], r["n"]) for r in found]
        next_id = N_BYTES + len(merges)
        taken = continued_merges(segments, limit, n_merges - len(merges), next_id)
        words = stage(_with_merges(words, taken, next_id), "bpe-words")
        merges += taken
        ahead = min(look_ahead, ahead * 2)
    return merges, words


def merged_tokens(merges: list[tuple[int, int]]) -> list[bytes]:
    tokens = [bytes([b]) for b in range(N_BYTES)]
    for left, right in merges:
        tokens.append(tokens[left] + tokens[right])
    return tokens


def learn_vocabulary(df: DataFrame, n_merges: int, text: str = "text", pattern: str = SUBWORD_SPLIT) -> Vocabulary:
    """A byte-pair vocabulary of 256 bytes, the learned merges, and end of text last."""
    merges, _ = learn_merges(df, n_merges, text, pattern)
    spark = df.sparkSession
    learned = list(enumerate(merged_tokens(merges)))[N_BYTES:]
    eos = N_BYTES + len(learned)
    table = byte_rows(spark)
    if learned:
        table = table.unionByName(
            spark.createDataFrame(
                [(i, t, False) for i, t in learned], "token_id int, token binary, is_special boolean"
            )
        )
    specials = {END_OF_TEXT: eos}
    return Vocabulary(table.unionByName(special_rows(spark, specials)), eos + 1, eos, pattern, specials)


def _merge_short(parts: list[bytes], ranks: dict[bytes, int] | RankFile) -> list[int]:
    """The same for a few parts: look through all pairs each time."""
    none = len(ranks) + N_BYTES + (1 << 40)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        at = pairs.index(best)
        parts[at] += parts.pop(at + 1)
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return [ranks[p] for p in parts]


def merge_piece(piece: bytes, ranks: dict[bytes, int] | RankFile) -> list[int]:
    """Join the lowest-ranked adjacent pair until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) <= SHORT_PIECE:
        return _merge_short(parts, ranks)
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))

    def candidate(at: int):
        right = after[at]
        if right < len(parts):
            joined = parts[at] + parts[right]
            if joined in ranks:
                heapq.heappush(queue, (ranks[joined], at, joined))

    queue: list[tuple[int, int, bytes]] = []
    for at in range(len(parts)):
        candidate(at)
    while queue:
        _, at, joined = heapq.heappop(queue)
        right = after[at]
        if not parts[at] or right >= len(parts) or parts[at] + parts[right] != joined:
            continue  # one of the two was merged away meanwhile
        parts[at], parts[right] = joined, b""
        after[at] = after[right]
        if after[at] < len(parts):
            before[after[at]] = at
        candidate(at)
        if before[at] >= 0:
            candidate(before[at])
    return [ranks[p] for p in parts if p]


def _encoded(column: pa.Array, lengths: np.ndarray, memo: dict[str, list[int]], table: dict[bytes, int] | RankFile) -> pa.Array:
    distinct = column.flatten().dictionary_encode()
    encoded = []
    for piece in distinct.dictionary.to_pylist():
        ids = memo.get(piece)
        if ids is None:
            ids = memo[piece] = merge_piece(piece.encode(), table)
        encoded.append(ids)
    per_piece = pa.array(encoded, pa.list_(pa.int32())).take(distinct.indices)
    # Offsets of pieces within rows, then of ids within pieces.
    row_ends = lengths.cumsum()
    id_ends = np.concatenate([[0], per_piece.value_lengths().to_numpy(zero_copy_only=False).cumsum()])
    ends = np.concatenate([[0], id_ends[row_ends]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), per_piece.flatten(), mask=column.is_null())


def piece_encoder(vocab: Vocabulary):
    """An Arrow function: array of pieces -> array of ids, each distinct piece encoded once.

    Ranks go to the tasks as a broadcast dictionary while ``Vocabulary.size`` allows it, as
    files mapped into memory beyond that; only the special tokens are then collected. The
    ids are the same.
    """
    spark = vocab.table.sparkSession
    names: list[str] = []
    if vocab.broadcastable:
        rows = vocab.table.select("token_id", "token", "is_special").collect()
        ranks = spark.sparkContext.broadcast({bytes(r["token"]): r["token_id"] for r in rows if not r["is_special"]})
    else:
        rows = vocab.table.filter("is_special").select("token_id", "token", "is_special").collect()
        ranks, names = None, publish(vocab.table.filter(~F.col("is_special")))
    specials = {r["token"].decode(): [r["token_id"]] for r in rows if r["is_special"] and bytes(r["token"]).decode() in vocab.specials}

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo: dict[str, list[int]] = dict(specials)
        table = ranks.value if ranks is not None else opened(names)
        for column in batches:
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            made = [pa.array([], pa.list_(pa.int32()))]
            for first, end in row_slices(lengths, SLICE_PIECES):
                if len(memo) > MEMO_PIECES:
                    memo = dict(specials)
                made.append(_encoded(column.slice(first, end - first), lengths[first:end], memo, table))
            yield pa.concat_arrays(made)

    return F.arrow_udf(encode, "array<int>")


def id_speller(vocab: Vocabulary):
    """An Arrow function: array of ids -> their tokens' bytes, one after the other.

    The tokens of a batch are taken from one table; the bytes of a row then lie side by
    side, so that only offsets are worked out.
    """
    if not vocab.broadcastable:
        raise ValueError(f"a vocabulary of {vocab.size} ids is too large to broadcast")
    rows = vocab.table.select("token_id", "token").collect()
    tokens = [b""] * (max((r["token_id"] for r in rows), default=-1) + 2)  # the last is for unknown ids
    for row in rows:
        tokens[row["token_id"]] = bytes(row["token"])
    shared = vocab.table.sparkSession.sparkContext.broadcast(tokens)

    def spell(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = pa.array(shared.value, pa.large_binary())
        unknown = len(table) - 1
        for column in batches:
            lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            made = [pa.array([], pa.binary())]
            for first, end in row_slices(lengths, SLICE_PIECES):
                ids = column.slice(first, end - first).flatten().fill_null(unknown).to_numpy(zero_copy_only=False)
                ids = np.where((ids >= 0) & (ids < unknown), ids, unknown)
                taken = table.take(pa.array(ids))
                ends = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
                at = np.concatenate([[0], lengths[first:end].cumsum()])
                made.append(pa.BinaryArray.from_buffers(pa.binary(), end - first, [None, pa.py_buffer(ends[at].astype(np.int32)), taken.buffers()[2]]))
            yield pa.concat_arrays(made)

    return F.arrow_udf(spell, "binary")
