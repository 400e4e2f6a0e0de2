"""Sorted runs of byte strings, front-coded, and their merge by a loser tree that knows LCPs.

A run holds records in order of their suffix. Front coding keeps, for each suffix, the
length of the prefix that it shares with the one before (its LCP) and the rest. The merge
never compares bytes whose outcome those lengths already tell: of two candidates, the one
that shares more with the last winner is the smaller; only equal lengths are compared, from
there on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Record = tuple[bytes, bytes, int, int]  # suffix, what stands before it, two hashes


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_coded(records: list[Record]) -> dict[str, bytes]:
    """Sort a run and front-code it, as packed arrays."""
    records = sorted(records)
    lcp, tails, before = [], [], b""
    for suffix, _, _, _ in records:
        shared = common(before, suffix)
        lcp.append(shared)
        tails.append(suffix[shared:])
        before = suffix
    return {
        "lcp": np.array(lcp, np.uint16).tobytes(),
        "tail": np.array([len(t) for t in tails], np.uint16).tobytes(),
        "tails": b"".join(tails),
        "left": np.array([len(r[1]) for r in records], np.uint16).tobytes(),
        "lefts": b"".join(r[1] for r in records),
        "hashes": np.array([r[2:] for r in records], np.uint64).reshape(len(records), 2).tobytes(),
    }


def decoded(run: dict[str, bytes]) -> Iterator[tuple[int, Record]]:
    """``(LCP with the one before, record)`` in order."""
    lcp = np.frombuffer(run["lcp"], np.uint16).tolist()
    tail = np.frombuffer(run["tail"], np.uint16).tolist()
    left = np.frombuffer(run["left"], np.uint16).tolist()
    hashes = np.frombuffer(run["hashes"], np.uint64).reshape(-1, 2).tolist()
    tails, lefts, t, at, suffix = run["tails"], run["lefts"], 0, 0, b""
    for shared, n, m, (a, b) in zip(lcp, tail, left, hashes, strict=True):
        suffix = suffix[:shared] + tails[t : t + n]
        yield shared, (suffix, lefts[at : at + m], a, b)
        t, at = t + n, at + m


def merged(runs: list[Iterator[tuple[int, Record]]]) -> Iterator[tuple[int, Record]]:
    """All records in order, with their LCPs, by a loser tree.

    Every entry is ``[LCP with the last winner, record, run]``; None stands for a run at its
    end. Against the last winner, more in common means smaller.
    """
    size = 1
    while size < len(runs):
        size *= 2
    losers: list = [None] * size

    def play(a, b):
        """Winner and loser; the loser's LCP becomes the one with the winner."""
        if a is None or b is None:
            return (b, a) if a is None else (a, b)
        if a[0] != b[0]:
            return (a, b) if a[0] > b[0] else (b, a)
        x, y = a[1][0], b[1][0]
        shared = common(x, y, a[0])
        if shared < len(x) and (shared == len(y) or x[shared] > y[shared]):
            a, b = b, a
        b[0] = shared
        return a, b

    def following(run: int):
        if run < len(runs):
            for shared, record in runs[run]:
                return [shared, record, run]
        return None

    # First round, bottom up: nothing is known yet, all LCPs are zero.
    level = [following(i) for i in range(size)]
    node = size
    while node > 1:
        node //= 2
        won = []
        for i in range(node):
            winner, losers[node + i] = play(level[2 * i], level[2 * i + 1])
            won.append(winner)
        level = won
    winner = level[0]
    while winner is not None:
        yield winner[0], winner[1]
        run = winner[2]
        winner = following(run)
        at = (size + run) // 2
        while at:
            winner, losers[at] = play(winner, losers[at])
            at //= 2
