"""Repair of damaged conversations by the cheapest edits.

A conversation shall have the roles ``(s?(ua)+)?``: perhaps a system row, then user and
assistant in turn.  Rows are kept, given another role, or deleted, and empty rows inserted;
blank and repeated rows must be deleted, cut-off ones cost more when they stay.

Every row becomes a symbol of its role's initial and its first fault.  Equal symbols in
sequence are one run.  A symbol has a min-plus matrix over the four states of the roles'
automaton: the least cost of going from state to state with that row, inserts before it
included.  The matrix of a run is put together from cached binary powers, so a
conversation costs a few steps a run, however long.  Costs to the end are found from the
last run to the first; the choices are then unrolled from the left, halving each run, and
of equally cheap ones the least letter is taken, which gives the least audit.

Rows go to their conversation twice.  The first time they carry only symbols and digests;
tasks read them in order and hold a conversation's runs.  The second time they carry
text, behind a row with the finished audit; tasks read them in order and hold one row.
So no task holds a conversation's texts, but a conversation's digest, being one hash of all
its text, is computed by one task.

Nulls are read as one space: a null text is blank, a null role no known one, and null
conversations are one conversation.  Null turns come first.  Rows of one turn are ordered by
role and by the digest of their text.  Empty texts are blank; repeated rows are duplicates.
Texts may be of any length that fits a task.  Extra columns are not read.  An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from kinbridge.llm.common import staged

# Roles, costs and the letters of the edits.
USER, ASSISTANT = "user", "assistant"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
LEGAL = ("su", "ua", "au")

BLANK, DUPLICATE, TRUNCATED, SOUND = "b", "d", "t", "-"
_VISIBLE = r"[^\x20\x09-\x0D]"

#: States: nothing yet, a system row, a user row, an assistant row (or none, at the start).
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = range(4)
#: The state after the next user or assistant row.
STEP = (ASKED, ASKED, ANSWERED, ASKED)
NEVER = 1 << 60
Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]

DIGESTS = ("blank", "duplicate", "truncated", "illegal", "cost")


# --- damage and faults -----------------------------------------------------------------


def _given(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copy) after damage; dropped ones have no copy."""
    kind = F.crc32(F.concat(_given("conv_id"), F.lit(":"), _given("turn")).cast("binary")) % 20
    role, text = _given("role"), _given("text")
    none, once, twice = (F.lit(x).cast("array<int>") for x in ([None], [0], [0, 1]))
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .withColumn("role", F.when(F.col("kind") == 4, F.lit(USER)).otherwise(F.col("role")))
        .withColumn(
            "text",
            F.when(F.col("kind") == 1, F.lit(""))
            .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")),
        )
        .withColumn(
            "copy",
            F.explode(
                F.when(F.col("kind") == 0, none).when(F.col("kind") == 3, twice).otherwise(once)
            ),
        )
        .drop("kind")
    )


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.asc("copy")]


def symbols(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copy, initial, fault) of rows after damage.

    A row is a duplicate if its conversation has its role and text earlier.
    """
    last = F.regexp_extract("text", rf"({_VISIBLE})[\x20\x09-\x0D]*\z", 1)
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        "copy",
        last.alias("last"),
    )
    same = Window.partitionBy("conv_id", "role", "digest", F.col("copy").isNull())
    again = F.row_number().over(same.orderBy(F.asc_nulls_first("turn"), "copy")) > 1
    fault = (
        F.when(F.col("last") == "", F.lit(BLANK))
        .when(again, F.lit(DUPLICATE))
        .when(~F.col("last").isin(*".!?"), F.lit(TRUNCATED))
        .otherwise(F.lit(SOUND))
    )
    return narrow.withColumn("fault", fault).select(
        "conv_id", "turn", "role", "digest", "copy", F.left("role", F.lit(1)).alias("initial"), "fault"
    )


# --- least costs and choices -----------------------------------------------------------


def _blocks(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """Letters, cost and next state of every way to pass one row, inserts before it included.

    More than two inserts, or two from ``ASKED`` or ``ANSWERED``, only come back to a state.
    """
    initial, fault = symbol
    found = []
    prefix, cost = "", 0
    for _ in range(3):
        found.append((prefix + DELETE, cost + DELETE_COST, state))
        if fault not in (BLANK, DUPLICATE):
            stays = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
            fits = {"s": state == START, "u": state != ASKED, "a": state == ASKED}
            if fits.get(initial, False):
                after = SYSTEM if initial == "s" else STEP[state]
                found.append((prefix + KEEP, stays, after))
            found.append((prefix + REROLE, stays + REROLE_COST, STEP[state]))
        prefix, cost, state = prefix + INSERT, cost + INSERT_COST, STEP[state]
    return found


@cache
def row_matrix(symbol: str) -> Matrix:
    rows = []
    for state in STATES:
        least = [NEVER] * len(STATES)
        for _, cost, after in _blocks(symbol, state):
            least[after] = min(least[after], cost)
        rows.append(tuple(least))
    return tuple(rows)


@cache
def power(symbol: str, exponent: int) -> Matrix:
    """The matrix of 2 ** exponent equal rows."""
    if not exponent:
        return row_matrix(symbol)
    half = power(symbol, exponent - 1)
    return tuple(
        tuple(min(NEVER, min(half[i][k] + half[k][j] for k in STATES)) for j in STATES)
        for i in STATES
    )


def _applied(matrix: Matrix, after: Vector) -> Vector:
    return tuple(min(matrix[i][k] + after[k] for k in STATES) for i in STATES)


def before_run(symbol: str, length: int, after: Vector) -> Vector:
    """Costs to the end before a run, from those after it."""
    exponent = 0
    while length:
        if length & 1:
            after = _applied(power(symbol, exponent), after)
        length >>= 1
        exponent += 1
    return after


#: Inserts that complete a conversation, and their costs.
ENDINGS = ("", INSERT * 2, INSERT, "")
AT_END: Vector = tuple(INSERT_COST * len(e) for e in ENDINGS)


@cache
def _one_choice(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    """The least letters among the cheapest ways to pass one row, and the next state.

    No block is the beginning of another, so the first one that is less makes the whole
    audit less.
    """
    ways = _blocks(symbol, state)
    least = min(cost + after[then] for _, cost, then in ways)
    return min((letters, then) for letters, cost, then in ways if cost + after[then] == least)


def _unrolled(symbol: str, length: int, state: int, after: Vector, out: list[str]) -> int:
    """Adds the letters of a run to ``out``; returns the state behind it."""
    if length == 1:
        low = min(after)
        letters, state = _one_choice(symbol, state, tuple(min(x - low, 64) for x in after))
        out.append(letters)
        return state
    half = 1 << ((length - 1).bit_length() - 1)
    middle = before_run(symbol, length - half, after)
    state = _unrolled(symbol, half, state, middle, out)
    return _unrolled(symbol, length - half, state, after, out)


def cheapest_edits(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of a conversation given as runs of symbols."""
    behind = [AT_END]
    for symbol, length in reversed(runs):
        behind.append(before_run(symbol, length, behind[-1]))
    cost = behind.pop()[START]
    out: list[str] = []
    state = START
    for symbol, length in runs:
        state = _unrolled(symbol, length, state, behind.pop(), out)
    return cost, "".join(out) + ENDINGS[state]


# --- conversations in order ------------------------------------------------------------


def _by_conversation(
    batches: Iterator[pa.RecordBatch], begin: Callable, names: list[str], types: list[pa.DataType]
) -> Iterator[pa.RecordBatch]:
    """Feeds sorted rows to one object per conversation and gathers their results."""
    now, found = None, []

    def full() -> pa.RecordBatch:
        columns = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names
        )

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv_id, *row in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    found.append(now.result())
                now = begin(conv_id)
            now.add(*row)
        if len(found) >= 500:
            yield full()
            found.clear()
    if now is not None:
        found.append(now.result())
    if found:
        yield full()


class _Audit:
    """One conversation's symbols, as they come in order."""

    def __init__(self, conv_id):
        self.conv_id, self.runs = conv_id, []
        self.first = self.last = None
        self.turns, self.illegal, self.initial = 0, 0, None
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0, SOUND: 0}

    def add(self, turn, copy, initial, fault):
        if copy is None:  # dropped by the damage
            return
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.faults[fault] += 1
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        # All rows that must go are alike, and so are all unknown roles.
        gone = fault in (BLANK, DUPLICATE)
        symbol = "x" + BLANK if gone else (initial if initial in ("s", "u", "a") else "x") + fault
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1] = (symbol, self.runs[-1][1] + 1)
        else:
            self.runs.append((symbol, 1))

    def result(self):
        cost, audit = cheapest_edits(self.runs)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = [self.faults[f] for f in (BLANK, DUPLICATE, TRUNCATED)]
        return (self.conv_id, gaps, *counts, self.illegal, cost, audit)


class _Repaired:
    """One conversation's digest, from its audit and then its rows in order."""

    def __init__(self, conv_id):
        self.conv_id, self.hash = conv_id, hashlib.sha256()
        self.audit, self.at, self.state, self.begun = "", 0, START, False
        self.given = ()

    def _write(self, role: str, text: str):
        if self.begun:
            self.hash.update(b"\n")
        self.begun = True
        self.hash.update(f"{role}:".encode())
        self.hash.update(text.encode())

    def _next(self, text: str):
        self.state = STEP[self.state]
        self._write(USER if self.state == ASKED else ASSISTANT, text)

    def _inserts(self):
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            self._next("")

    def add(self, copy, role, text, given):
        if given is not None:
            self.given, self.audit = tuple(given.values()), given["audit"]
            return
        if copy is None:
            return
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == REROLE:
            self._next(text)
        elif edit == KEEP:
            self.state = SYSTEM if role[:1] == "s" else STEP[self.state]
            self._write(role, text)

    def result(self):
        self._inserts()
        return (self.conv_id, *self.given, self.hash.hexdigest())


def audits(narrow: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, illegal, cost, audit."""
    kind = narrow.schema["conv_id"].dataType
    names = ["conv_id", "gaps", *DIGESTS, "audit"]
    schema = T.StructType([T.StructField("conv_id", kind)])
    for name in names[1:-1]:
        schema = schema.add(name, T.LongType())
    schema = schema.add("audit", T.StringType())
    arrow = _arrow(kind)

    def run(batches):
        types = [arrow, *[pa.int64()] * 6, pa.string()]
        return _by_conversation(batches, _Audit, names, types)

    ordered = narrow.repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    return ordered.select("conv_id", "turn", "copy", "initial", "fault").mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def repaired(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Damages conversations and repairs them; one row per conversation.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of the
    repaired rows as ``role:text`` lines.
    """
    after = damaged(rows.select("conv_id", "turn", "role", "text"))
    found = staged(spark, audits(symbols(after)), "audits")
    kind = rows.schema["conv_id"].dataType
    given = F.struct(*(c for c in found.columns if c != "conv_id")).alias("given")
    turn, text = rows.schema["turn"].dataType, F.lit(None).cast("string")
    heads = found.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.lit(None).cast(turn).alias("turn"),
        text.alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("int").alias("copy"),
        text.alias("text"),
        given,
    )
    bodies = after.where("copy IS NOT NULL").select(
        "conv_id",
        F.lit(1).alias("kind"),
        "turn",
        "role",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        "copy",
        "text",
        F.lit(None).cast(heads.schema["given"].dataType).alias("given"),
    )
    both = heads.unionByName(bodies).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", "kind", *_order())
    schema = T.StructType([*found.schema.fields, T.StructField("repaired_sha256", T.StringType())])
    arrow = _arrow(kind)

    def run(batches):
        types = [arrow, *[pa.int64()] * 6, pa.string(), pa.string()]
        return _by_conversation(batches, _Repaired, schema.names, types)

    return ordered.select("conv_id", "copy", "role", "text", "given").mapInArrow(run, schema)
