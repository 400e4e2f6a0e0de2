"""Repair of conversation structure by the cheapest edits: a run-length min-plus dynamic program.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: maybe a system turn,
then user and assistant in turn. Each row is kept (free), given the role that is due (``R``), or deleted
(``D``); rows without roles or texts of their own are inserted (``I``). Blank rows and repeats of an earlier
row must go; truncated rows cost extra if they stay. Among the cheapest ways the one whose edits,
spelled in order, come first in ASCII is taken.

A row is one of twelve symbols: initial s, u, a or other; sound, to be deleted or truncated. Its effect
on the four states of the pattern is a 4 x 4 matrix of costs in the (min, +) semiring. Equal
symbols in a row are one run; its matrix is a product of binary powers, which are cached per symbol.
The cost to go is carried from the end over the runs; then each run is unrolled from the
same powers into the choices of its rows.

Rows are shuffled once, by ranges of (conversation, turn), and sorted. A conversation that
lies inside one task is repaired there. One that touches a task's edge, or is longer than ``HOLD``
rows, is cut into blocks of at most ``HOLD`` rows: the blocks' matrices are multiplied
up per conversation (16 numbers a block), which gives each block its cost to go; the
blocks then say where each of the four states leads, which gives each its first
state. So a conversation that holds a third of all rows spreads over the tasks, and the
result does not depend on how rows are dealt.

Defined results: null roles and texts are empty, so null texts are blank. Rows of one turn are ordered by role,
then by the MD5 of their text; null turns are first, and a null conversation is one of its own.
Of equal rows the first stays. A role whose initial is not s, u or a is never kept. A very
long text is not read but for its end. Empty tables give empty results; other
columns are not looked at, whatever their names. Equality of rows rests on the MD5 of role and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby
from operator import and_

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm.arrow import column
from corpusloom.session import stage

HOLD = 100_000
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\f\r"

# States: nothing said, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
SOUND, GONE, CUT = range(3)
DUE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 50
Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]
#: Cost to go after the last row: what it takes to reach the start or an assistant's turn.
CLOSING: Vector = (0, 2 * INSERT, INSERT, 0)
_CACHED_POWER = 6  # unrolled runs of up to 2**6 rows are remembered


@lru_cache(maxsize=None)
def moves(symbol: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """``(edits, cost, next state)`` of one row, inserted turns before it included; ASCII order.

    More than two turns inserted lead to a state that fewer reach.
    """
    initial, fault = divmod(symbol, 3)
    extra = TRUNCATED if fault == CUT else 0
    out = []
    for n in range(3):
        spent = n * INSERT
        out.append(("I" * n + "D", spent + DELETE, state))
        if fault != GONE:
            out.append(("I" * n + "R", spent + REROLE + extra, DUE[state]))
            if (state, initial) in KEPT:
                out.append(("I" * n + "K", spent + extra, KEPT[state, initial]))
        state = DUE[state]
    return tuple(sorted(out))


def product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(NEVER, *(a[i][k] + v[k] for k in range(4))) for i in range(4))


IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> Matrix:
    """The matrix of ``2**k`` rows of one symbol."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    rows = []
    for state in range(4):
        best = [NEVER] * 4
        for _, cost, after in moves(symbol, state):
            best[after] = min(best[after], cost)
        rows.append(tuple(best))
    return tuple(rows)


def bits(n: int) -> list[int]:
    """Exponents of the powers of two that add up to ``n``, the largest first."""
    return [k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def runs_of(symbols: list[int]) -> list[tuple[int, int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(symbols)]


def matrix_of(runs: list[tuple[int, int]]) -> Matrix:
    return reduce(product, (power(symbol, k) for symbol, n in runs for k in bits(n)), IDENTITY)


def _lowered(v: Vector) -> Vector:
    least = min(v)
    return tuple(x - least for x in v)


def _unrolled(symbol: int, k: int, after: Vector, state: int) -> tuple[tuple[tuple[str, int], ...], int]:
    """Choices of ``2**k`` rows from ``state`` on, if ``after`` is the cost to go behind them."""
    return (_unrolled_cached if k <= _CACHED_POWER else _unroll)(symbol, k, _lowered(after), state)


def _unroll(symbol: int, k: int, after: Vector, state: int):
    if not k:
        edits, _, to = min(moves(symbol, state), key=lambda m: (m[1] + after[m[2]], m[0]))
        return ((edits, to),), to
    head, middle = _unrolled(symbol, k - 1, applied(power(symbol, k - 1), after), state)
    tail, end = _unrolled(symbol, k - 1, after, middle)
    return head + tail, end


_unrolled_cached = lru_cache(maxsize=1 << 14)(_unroll)


def choices(runs: list[tuple[int, int]], after: Vector, state: int) -> tuple[list[tuple[str, int]], int]:
    """``(edits, state behind it)`` of each row, and the last state."""
    pieces = []
    for symbol, n in reversed(runs):
        for k in reversed(bits(n)):
            pieces.append((symbol, k, after))
            after = applied(power(symbol, k), after)
    out: list[tuple[str, int]] = []
    for symbol, k, behind in reversed(pieces):
        made, state = _unrolled(symbol, k, behind, state)
        out += made
    return out, state


def _steps(state: int, edits: str, after: int) -> list[tuple[str, str | None]]:
    """The edits of a row one by one, with the role each gives; ``state`` is before them."""
    out: list[tuple[str, str | None]] = []
    for edit in edits:
        if edit == "I":
            state = DUE[state]
        out.append((edit, ROLE[state] if edit == "I" else ROLE[after] if edit == "R" else None))
    return out


def _closing(state: int) -> list[tuple[str, str | None]]:
    n = CLOSING[state] // INSERT
    return [("I", ROLE[s]) for s in ((USER, ASSISTANT)[-n:] if n else ())]


_NEW = (
    "block bigint, ord bigint, sub int, open boolean, again boolean, fault string, edit string, new_role string"
)


def _faults(table: pa.RecordBatch, begin: int, end: int, seen: set[bytes]) -> list[tuple[str, bool]]:
    """The first fault of each row, and whether an equal row came before."""
    part = table.slice(begin, end - begin)
    out = []
    for key, blank, cut in zip(*(column(part, c).to_pylist() for c in ("key", "blank", "cut")), strict=True):
        again = key in seen
        seen.add(key)
        out.append(("blank" if blank else "duplicate" if again else "truncated" if cut else "", again))
    return out


_FAULT = {"": SOUND, "blank": GONE, "duplicate": GONE, "truncated": CUT}


class _Part:
    """The sorted rows of one task: whole conversations repaired, those at its edges left open."""

    def __init__(self, number: int, hold: int, schema: pa.Schema):
        self.first_block, self.hold, self.schema = number << 32, hold, schema
        self.block, self.n_block, self.seen = self.first_block, 0, set()
        self.base = 0  # rows written
        self.rows: list[int | None] = []
        self.new: list[tuple] = []

    def leave_open(self, table: pa.RecordBatch, begin: int, end: int, fresh: bool) -> None:
        while begin < end:
            if fresh or self.n_block == self.hold:
                self.block, self.n_block, self.seen, fresh = self.block + 1, 0, set(), False
            upto = min(end, begin + self.hold - self.n_block)
            for i, (fault, again) in enumerate(_faults(table, begin, upto, self.seen), begin):
                self.rows.append(i)
                self.new.append((self.block, self.base + i, 0, True, again, fault, None, None))
            self.n_block += upto - begin
            begin = upto

    def repair(self, table: pa.RecordBatch, begin: int, end: int) -> None:
        faults = _faults(table, begin, end, set())
        kinds = column(table, "kind").slice(begin, end - begin).to_pylist()
        runs = runs_of([3 * kind + _FAULT[fault] for kind, (fault, _) in zip(kinds, faults, strict=True)])
        made, last = choices(runs, CLOSING, START)
        state = START
        for i, ((edits, after), (fault, again)) in enumerate(zip(made, faults, strict=True), begin):
            steps = _steps(state, edits, after)
            if i == end - 1:
                steps += _closing(last)
            for sub, (edit, role) in enumerate(steps):
                self.rows.append(None if edit == "I" else i)
                self.new.append((self.first_block, self.base + i, sub, False, again, "" if edit == "I" else fault, edit, role))
            state = after

    def written(self, table: pa.RecordBatch, upto: int) -> pa.RecordBatch:
        """What was made of the first ``upto`` rows."""
        taken = table.take(pa.array(self.rows, pa.int64()))
        arrays = [column(table, "conv_id").take(pa.array([n[1] - self.base for n in self.new], pa.int64()))]
        arrays += [taken.column(i) for i in range(1, table.num_columns)]
        arrays += [pa.array(c, self.schema.field(n).type) for n, c in zip(_new_names(), zip(*self.new, strict=True), strict=True)]
        self.rows, self.new = [], []
        self.base += upto
        return pa.RecordBatch.from_arrays(arrays, self.schema.names)


def _new_names() -> list[str]:
    return [f.split()[0] for f in _NEW.split(", ")]


def _repaired_parts(batches: Iterator[pa.RecordBatch], hold: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part = _Part(TaskContext.get().partitionId(), hold, schema)
    open_id: list = []  # the conversation that is open now, if any
    started, left = False, None
    for batch in batches:
        if left is not None:
            batch = pa.Table.from_batches([left, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        ids = column(batch, "conv_id").to_pylist()
        cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        done = 0
        for begin, end in zip(cuts, cuts[1:], strict=False):
            fresh = [ids[begin]] != open_id
            if not started or not fresh:  # touches the task's beginning, or is open already
                open_id = [ids[begin]]
                part.leave_open(batch, begin, end, not started or fresh)
            elif end < len(ids):
                open_id = []
                part.repair(batch, begin, end)
            elif end - begin > hold:
                open_id = [ids[begin]]
                part.leave_open(batch, begin, end, True)
            else:
                break  # may go on in the next batch
            started, done = True, end
        left = batch.slice(done) if done < len(ids) else None
        if done:
            yield part.written(batch, done)
    if left is not None:
        part.leave_open(left, 0, left.num_rows, True)
        yield part.written(left, left.num_rows)


def _met(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner", also: Column | None = None) -> DataFrame:
    """``a`` with the other columns of ``b`` where ``names`` are equal; nulls are."""
    own = {n: f"_{n}" for n in names}
    on = [F.col(n).eqNullSafe(F.col(o)) for n, o in own.items()]
    met = a.join(b.withColumnsRenamed(own), reduce(and_, on if also is None else [*on, also]), how)
    return met.drop(*own.values())


def _block_matrix(symbols):
    return [x for row in matrix_of(runs_of(symbols)) for x in row]


def _costs_to_go(blocks):
    after, out = CLOSING, []
    for row in reversed(blocks):
        out.append((row["block"], list(after)))
        m = row["matrix"]
        after = _lowered(applied(tuple(tuple(m[4 * i : 4 * i + 4]) for i in range(4)), after))
    return out


def _ends(symbols, after):
    runs = runs_of(symbols)
    return [choices(runs, tuple(after), state)[1] for state in range(4)]


def _first_states(blocks):
    state, out = START, []
    for i, row in enumerate(blocks, 1):
        out.append((row["block"], state, i == len(blocks)))
        state = row["ends"][state]
    return out


def _block_steps(symbols, after, first, last):
    made, end = choices(runs_of(symbols), tuple(after), first)
    out, state = [], first
    for edits, to in made:
        out.append(_steps(state, edits, to))
        state = to
    if last:
        out[-1] = out[-1] + _closing(end)
    return out


def _repaired_open(rows: DataFrame) -> DataFrame:
    """The rows of conversations cut into blocks, repaired from the blocks' matrices."""
    matrix = F.udf(_block_matrix, "array<bigint>")
    costs_to_go = F.udf(_costs_to_go, "array<struct<block:bigint,after:array<bigint>>>")
    ends = F.udf(_ends, "array<int>")
    first_states = F.udf(_first_states, "array<struct<block:bigint,first:int,last:boolean>>")
    block_steps = F.udf(_block_steps, "array<array<struct<edit:string,new_role:string>>>")

    narrow = rows.select("conv_id", "block", "ord", "key", "kind", "again", "fault", "cut")
    firsts = narrow.filter("NOT again AND fault <> 'blank'").groupBy("conv_id", "key")
    firsts = firsts.agg(F.min("block").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    found = _met(narrow, firsts, ["conv_id", "key"], "left", ~F.col("again"))  # at most one row a block
    fault = F.when((F.col("first") < F.col("block")) & (F.col("fault") != "blank"), "duplicate").otherwise(F.col("fault"))
    found = found.withColumn("fault", fault)
    kinds = F.create_map(*[F.lit(x) for pair in _FAULT.items() for x in pair])
    row = F.struct("ord", (F.col("kind") * 3 + kinds[F.col("fault")]).alias("symbol"), "fault")
    blocks = found.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    blocks = blocks.select(
        "conv_id", "block", F.col("rows")[0]["ord"].alias("begin"), F.col("rows.symbol").alias("symbols"), F.col("rows.fault").alias("faults")
    )
    blocks = stage(blocks, "repair-blocks")

    up = blocks.select("conv_id", F.struct("block", matrix("symbols").alias("matrix")).alias("b"))
    up = up.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("blocks"))
    after = up.select("conv_id", F.inline(costs_to_go("blocks")))
    going = stage(_met(blocks, after, ["conv_id", "block"]), "repair-costs")

    down = going.select("conv_id", F.struct("block", ends("symbols", "after").alias("ends")).alias("b"))
    down = down.groupBy("conv_id").agg(F.array_sort(F.collect_list("b")).alias("blocks"))
    first = down.select("conv_id", F.inline(first_states("blocks")))
    made = F.arrays_zip(block_steps("symbols", "after", "first", "last").alias("steps"), "faults")
    steps = _met(going, first, ["conv_id", "block"]).select("conv_id", "block", "begin", F.posexplode(made).alias("i", "made"))
    steps = steps.select(
        "conv_id", "block", (F.col("begin") + F.col("i")).alias("ord"), F.col("made.steps").alias("_steps"), F.col("made.faults").alias("_fault")
    )
    out = _met(rows.select("conv_id", "block", "ord", "turn", "role", "text"), steps, ["conv_id", "block", "ord"])
    out = out.select("*", F.posexplode("_steps").alias("_sub", "_step"))
    own = lambda c: F.when(F.col("_step.edit") != "I", F.col(c))
    return out.select(
        "conv_id", "block", "ord", F.col("_sub").alias("sub"), own("turn").alias("turn"), own("role").alias("role"), own("text").alias("text"),
        F.coalesce(own("_fault"), F.lit("")).alias("fault"), F.col("_step.edit").alias("edit"), F.col("_step.new_role").alias("new_role"),
    )


def with_edits(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", hold: int = HOLD) -> DataFrame:
    """Every row with its first fault and the edit that it gets, and the rows to insert.

    ``conv_id, block, ord, sub, turn, role, text, fault, edit, new_role``: order by block, ord and sub
    within a conversation. ``fault`` is blank, duplicate, truncated or empty; ``edit`` is
    K, R, D or I; ``new_role`` is given by R and I. Inserted rows have null turn, role and text.
    """
    own_role, own_text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), own_role.alias("role"), own_text.alias("text"))
    ended = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.lit(len(INITIALS))
    for i, letter in enumerate(INITIALS):
        kind = F.when(initial == letter, i).otherwise(kind)
    last = F.right(ended, F.lit(1))
    rows = rows.select(
        "conv_id", "turn", "role", "text",
        F.unhex(F.md5(F.concat(F.char_length("role"), F.lit(":"), "role", "text").cast("binary"))).alias("key"),
        kind.alias("kind"), (ended == "").alias("blank"), ((ended != "") & ~last.isin(".", "!", "?")).alias("cut"),
        F.md5(F.col("text").cast("binary")).alias("tie"), F.spark_partition_id().alias("dealt"),
    )
    # Equal rows may meet in any order: ``dealt`` spreads a hot one.
    order = ["conv_id", "turn", "role", "tie"]
    ranged = rows.repartitionByRange(*order, "dealt").sortWithinPartitions(*order).drop("tie", "dealt")
    own = [T.StructField(f.name, f.dataType) for f in ranged.schema.fields]  # inserted rows have nulls
    schema = T.StructType([*own, *T._parse_datatype_string(_NEW).fields])
    arrow = to_arrow_schema(schema)
    parts = stage(ranged.mapInArrow(lambda b: _repaired_parts(b, hold, arrow), schema), "repair-parts")
    names = ["conv_id", "block", "ord", "sub", "turn", "role", "text", "fault", "edit", "new_role"]
    return parts.filter("NOT open").select(*names).unionByName(_repaired_open(parts.filter("open")))


def repaired(edits: DataFrame) -> DataFrame:
    """The turns that are left: ``conv_id, block, ord, sub, role, text``."""
    kept = edits.filter("edit <> 'D'")
    return kept.select(
        "conv_id", "block", "ord", "sub", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


class Audit:
    """Counts, cost, edits and digest of one conversation, from its rows in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.distinct = 0
        self.low = self.high = self.initial = None
        self.edits: list[str] = []
        self.text, self.any = hashlib.sha256(), False

    def add(self, row: dict) -> None:
        edit, fault = row["edit"], row["fault"]
        self.edits.append(edit)
        self.cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if edit != "I":
            self._see(row)
            if fault:
                setattr(self, fault, getattr(self, fault) + 1)
            if fault == "truncated" and edit != "D":
                self.cost += TRUNCATED
        if edit != "D":
            role = row["new_role"] or row["role"]
            self.text.update(("\n" * self.any + f"{role}:{row['text'] or ''}").encode())
            self.any = True

    def _see(self, row: dict) -> None:
        initial, turn = row["role"][:1], row["turn"]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None:
            if turn != self.high:
                self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def result(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        names = ("blank", "duplicate", "truncated", "illegal", "cost")
        return {"gaps": gaps} | {n: getattr(self, n) for n in names} | {"audit": "".join(self.edits), "repaired_sha256": self.text.hexdigest()}


AUDIT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
