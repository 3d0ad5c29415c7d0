"""Repair of conversation structure: cheapest edits that give a legal order of roles."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rankloom.llm.common import bounded_batches, stored
from rankloom.operators.ordered import OrderedGroups

#: Costs of the edits; an undeleted truncated turn costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns whose symbols one group gathers before they are joined to those of the whole conversation.
BLOCK = 1 << 16
NEVER = 1 << 60

# States of the written roles: nothing yet, a system turn, last a user turn, last an assistant turn.
# Legal ends are nothing and an assistant turn: roles spell (s?(ua)+)?.
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
#: The state after a turn that is made to fit (rerole, insert): user and assistant take turns.
FITTING = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: States in which a kept turn of this initial may follow, and the state it leads to.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Symbol of a turn that must go; others are its role's initial (or "o"), in capitals if truncated.
GONE = "-"

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def product(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: the least cost of going through a, then b."""
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES)


def applied(a: Matrix, v: Vector) -> Vector:
    """Least cost from every state through ``a`` to an end that costs ``v``."""
    return tuple(min(a[i][k] + v[k] for k in STATES) for i in STATES)


def _matrix(steps: Iterable[tuple[int, int, int]]) -> Matrix:
    rows = [[NEVER] * 4 for _ in STATES]
    for before, after, cost in steps:
        rows[before][after] = min(rows[before][after], cost)
    return tuple(map(tuple, rows))


_ONE_INSERT = _matrix([(q, q, 0) for q in STATES] + [(q, FITTING[q], INSERT) for q in STATES])
#: Any number of inserted turns; more than two never pay.
INSERTS = product(_ONE_INSERT, _ONE_INSERT)
#: Cost from every state to a legal end when no turn is left.
END: Vector = applied(INSERTS, tuple(0 if q in (START, ASSISTANT) else NEVER for q in STATES))


@lru_cache(maxsize=None)
def choices(symbol: str) -> dict[int, list[tuple[str, int, int]]]:
    """For every state the edits (initial, cost, next state) of a turn in ASCII order, without inserts."""
    more = TRUNCATED if symbol.isupper() else 0
    found = {}
    for q in STATES:
        found[q] = [("D", DELETE, q)]
        if symbol != GONE:
            if q in KEPT.get(symbol.lower(), {}):
                found[q].append(("K", more, KEPT[symbol.lower()][q]))
            found[q].append(("R", REROLE + more, FITTING[q]))
    return found


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> Matrix:
    """The transition of 2^k turns of one symbol, inserts before each included."""
    if k == 0:
        return product(INSERTS, _matrix((q, after, c) for q in STATES for _, c, after in choices(symbol)[q]))
    half = power(symbol, k - 1)
    return product(half, half)


def run_vector(symbol: str, count: int, v: Vector) -> Vector:
    """Cost from every state through a run of ``count`` equal symbols to an end that costs ``v``."""
    for k in range(count.bit_length()):
        if count >> k & 1:
            v = applied(power(symbol, k), v)
    return v


def normal(v: Vector) -> Vector:
    """The costs above the least one; every state has a way to the end."""
    return tuple(x - min(v) for x in v)


@lru_cache(maxsize=1 << 14)
def unroll(symbol: str, k: int, state: int, v: Vector) -> tuple[str, int]:
    """The ASCII-least cheapest edits of 2^k turns of a symbol from ``state`` before an end that costs
    ``v`` (its least cost taken off), and the state behind them."""
    if k:
        middle = normal(applied(power(symbol, k - 1), v))
        first, state = unroll(symbol, k - 1, state, middle)
        second, state = unroll(symbol, k - 1, state, v)
        return first + second, state
    edits = ""
    while True:
        left = applied(power(symbol, 0), v)
        options = [(i, c, q) for i, c, q in choices(symbol)[state] if c + v[q] == left[state]]
        if options and options[0][0] == "D":
            return edits + "D", options[0][2]
        if INSERT + left[FITTING[state]] == left[state]:
            edits, state = edits + "I", FITTING[state]
            continue
        return edits + options[0][0], options[0][2]


def runs_of(symbols: Iterable[tuple[str, int]]) -> list[tuple[str, int]]:
    """Equal consecutive symbols collapsed."""
    return [(s, sum(n for _, n in same)) for s, same in groupby(symbols, key=lambda x: x[0])]


def cheapest_edits(runs: list[tuple[str, int]]) -> tuple[int, str]:
    """The least cost of edits that make the turns legal, and the ASCII-least of the cheapest."""
    ends = [END]
    for symbol, count in reversed(runs):
        ends.append(run_vector(symbol, count, ends[-1]))
    edits, state = [], START
    for (symbol, count), end in zip(runs, reversed(ends[:-1]), strict=True):
        # The largest power comes first; what is left of the run leads from it to the end.
        for k in reversed(range(count.bit_length())):
            if count >> k & 1:
                count -= 1 << k
                part, state = unroll(symbol, k, state, normal(run_vector(symbol, count, end)))
                edits.append(part)
    edits.append("I" * (END[state] // INSERT))  # behind the last turn
    return ends[-1][START], "".join(edits)


#: Initials that may follow each other.
LEGAL = ("su", "ua", "au")
#: A turn in a conversation's line of symbols: symbol, initial, number of equal rows behind it.
TOKEN = re.compile(r"(.)(.)(?:#(\d+);)?")
BLANK, CUT = r"\A[\x20\x09-\x0D]*\z", r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z"


def numbered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows (_group, conversation, turn, role, text, copies, fault, symbol) with their place.

    Equal rows are counted before they are shuffled. The place is that of a row's first copy among
    all rows of its conversation, by turn (nulls first), role and text; long conversations are
    numbered by pieces.
    """
    rows = turns.select(
        F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.lit("")).alias("_group"),
        F.col(conv).alias("_conv"), F.col(turn).alias("_turn"),
        F.coalesce(role, F.lit(" ")).alias("_role"), F.coalesce(text, F.lit(" ")).alias("_text"),
    )
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    said = Window.partitionBy("_group", "_role", "_text").orderBy(F.col("_turn").asc_nulls_first())
    initial = F.substring("_role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    fault = (
        F.when(F.col("_text").rlike(BLANK), "blank")
        .when(F.col("_again"), "duplicate")
        .when(F.col("_text").rlike(CUT), "truncated")
    )
    rows = (
        rows.withColumn("_again", F.row_number().over(said) > 1)
        .withColumns({"_fault": fault, "_initial": initial})
        .withColumn(
            "_symbol",
            F.when(F.col("_fault").isin("blank", "duplicate"), GONE)
            .when(F.col("_fault") == "truncated", F.upper("_initial"))
            .otherwise(F.col("_initial")),
        )
        .drop("_again")
    )
    order = [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_text")]
    placed = OrderedGroups(stored(rows, "turns"), ["_group"], order).running({"_end": F.col("_copies")}).df
    return stored(placed.withColumn("_place", F.col("_end") - F.col("_copies") + 1).drop("_end"), "turns")


def symbol_lines(rows: DataFrame) -> DataFrame:
    """(_group, line): the tokens of all turns of a conversation, gathered block by block."""
    more = F.when(F.col("_copies") > 1, F.format_string("#%d;", F.col("_copies") - 1)).otherwise("")
    token = F.concat("_symbol", "_initial", more)

    def joined(place: str, what: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(place, what)))
        return F.array_join(F.transform(ordered, lambda x: x[what]), "")

    blocks = (
        rows.select("_group", "_place", F.floor(F.col("_place") / BLOCK).alias("_block"), token.alias("_token"))
        .groupBy("_group", "_block")
        .agg(joined("_place", "_token").alias("_part"))
    )
    return blocks.groupBy("_group").agg(joined("_block", "_part").alias("line"))


def _tokens(line: str) -> Iterator[tuple[str, str, int]]:
    for found in TOKEN.finditer(line):
        yield found[1], found[2], int(found[3] or 0)


def symbols(line: str) -> Iterator[tuple[str, int]]:
    """The symbols of a line; copies of a turn must go."""
    for symbol, _, more in _tokens(line):
        yield symbol, 1
        if more:
            yield GONE, more


def illegal_pairs(line: str) -> int:
    """Neighbours whose initials may not follow each other."""
    pairs, last = 0, None
    for _, initial, more in _tokens(line):
        pairs += (last is not None and last + initial not in LEGAL) + more
        last = initial
    return pairs


def edits_of(lines: DataFrame) -> DataFrame:
    """(_group, illegal, cost, audit) of every line of symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cheapest_edits(runs_of(symbols(line))) for line in batch.column(1).to_pylist()]
            illegal = [illegal_pairs(line) for line in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(illegal, pa.int64()),
                    pa.array([c for c, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string()),
                ],
                names=["_group", "illegal", "cost", "audit"],
            )

    return bounded_batches(lines).mapInArrow(run, "_group string, illegal bigint, cost bigint, audit string")


def written_turns(edits: DataFrame) -> DataFrame:
    """(_group, place, role, _place) of the turns that are left: which row they come from.

    Roles follow from the places, as a legal order begins with the system turn if its length is odd. A
    kept turn has no new role, an inserted one no row.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            for group, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                marks = np.frombuffer(audit.encode(), np.uint8)
                row = np.cumsum(marks != ord("I"))
                left = np.flatnonzero(marks != ord("D"))
                place = np.arange(len(left))
                answers = (place + len(left)) % 2 == 1
                for start in range(0, len(left), BLOCK):
                    cut = slice(start, start + BLOCK)
                    yield [group] * len(place[cut]), place[cut], answers[cut], row[left[cut]], marks[left[cut]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def batch() -> pa.RecordBatch:
            groups = [g for w in waiting for g in w[0]]
            place, answers, row, marks = (np.concatenate([w[i] for w in waiting]) for i in range(1, 5))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(groups, pa.string()), pa.array(place, pa.int64()),
                    pa.array(np.where(answers, "assistant", "user"), pa.string(), mask=marks == ord("K")),
                    pa.array(row, pa.int64(), mask=marks == ord("I")),
                ],
                names=["_group", "place", "role", "_place"],
            )

        for found in rows(batches):
            waiting.append(found)
            size += len(found[0])
            if size >= BLOCK:
                yield batch()
                waiting, size = [], 0
        if waiting:
            yield batch()

    return bounded_batches(edits.select("_group", "audit")).mapInArrow(
        run, "_group string, place bigint, role string, _place bigint"
    )


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Reports (one row per conversation) and repaired turns (conversation, place, role, text).

    Rows are read by turn (nulls first), then role and text; null roles and texts are one space. A
    turn's first fault counts: blank, duplicate (role and text seen before) or truncated (its last
    character that is no white space is none of ``.!?``). Blank and duplicate turns are deleted;
    others are kept, deleted or given another role, and empty turns are inserted, so that the
    initials of the roles spell ``(s?(ua)+)?`` at the least cost. A report has the conversation, the
    gaps in its turn numbers (nulls ignored), the numbers of faults, illegal (neighbours that may not
    follow each other), cost and audit: the initials of the edits Keep, Rerole, Delete, Insert in
    order, the ASCII-least of the cheapest. Places of repaired turns count from 0.

    Rows of a null conversation are one conversation; an empty table gives empty tables; other columns
    are left out, whatever their names.

    Equal rows are counted first, faults and places found by Spark. What one task gets of a
    conversation is its line of symbols, two bytes a turn: equal consecutive symbols are collapsed, a run's
    costs come from binary powers of its min-plus transition, and its edits are unrolled along the
    same powers. Texts meet the edits by conversation and place.
    """
    rows = numbered_turns(turns, conv, turn, role, text)
    edits = stored(edits_of(symbol_lines(rows)), "edits")

    def number(fault: str) -> Column:
        first = F.sum(F.when(F.col("_fault") == fault, F.lit(1)).otherwise(0))
        copies = F.col("_copies") - 1
        if fault == "blank":
            return first + F.sum(F.when(F.col("_fault") == fault, copies).otherwise(0))
        if fault == "duplicate":
            return first + F.sum(F.when(F.coalesce(F.col("_fault") == "blank", F.lit(False)), 0).otherwise(copies))
        return first

    faults = ("blank", "duplicate", "truncated")
    counted = rows.groupBy("_group", "_conv", "_turn").agg(*[number(f).alias(f) for f in faults])
    counted = counted.groupBy("_group", "_conv").agg(
        F.coalesce(F.max("_turn") - F.min("_turn") + 1 - F.count("_turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(f).cast("long").alias(f) for f in faults],
    )
    reports = counted.join(edits, "_group").select(
        F.col("_conv").alias(conv), "gaps", *faults, "illegal", "cost", "audit"
    )
    texts = rows.select("_group", "_place", F.col("_role"), F.col("_text"))
    ids = counted.select("_group", "_conv")
    left = written_turns(edits).join(texts, ["_group", "_place"], "left").join(ids, "_group")
    return reports, left.select(
        F.col("_conv").alias(conv), "place", F.coalesce("role", "_role").alias("role"),
        F.coalesce("_text", F.lit("")).alias("text"),
    )


def line_digests(lines: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conversation, repaired_sha256) of all ``role:text`` lines by place, joined by line ends.

    The hash takes the lines one after the other as they come from the sorted partition, so a
    conversation of any length needs no more memory than a batch.
    """
    kind, id_type = lines.schema[conv].dataType.simpleString(), to_arrow_type(lines.schema[conv].dataType)
    rows = lines.select(F.col(conv).alias("_conv"), "place", F.concat("role", F.lit(":"), "text").alias("_line"))
    rows = bounded_batches(rows.repartition("_conv").sortWithinPartitions("_conv", "place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[object, str]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)

        done: list[tuple[object, str]] = []

        def batch_of() -> pa.RecordBatch:
            made = [pa.array([c for c, _ in done], id_type), pa.array([h for _, h in done], pa.string())]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=["_conv", "repaired_sha256"])

        for conv_id, own in groupby(parts(), key=lambda x: x[0]):
            sha, between = hashlib.sha256(), b""
            for _, line in own:
                sha.update(between + line.encode())
                between = b"\n"
            done.append((conv_id, sha.hexdigest()))
            if len(done) >= BLOCK:
                yield batch_of()
        if done:
            yield batch_of()

    return rows.mapInArrow(run, f"_conv {kind}, repaired_sha256 string").withColumnRenamed("_conv", conv)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by the checksum of ``conv_id:turn`` (nulls are one space), for trials.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row
    and 4 gives it to the user.
    """
    space = F.lit(" ")
    turns = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    turns = turns.withColumn("_code", F.crc32(F.encode(key, "UTF-8")) % 20).filter("_code <> 0")
    return turns.select(
        "conv_id", "turn", F.when(F.col("_code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_code") == 1, "")
        .when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def repair_digests(turns: DataFrame) -> DataFrame:
    """Reports of the damaged turns with the hash of the repaired ones, a row for every conversation."""
    reports, lines = repair(damaged(turns))
    digests = line_digests(lines)
    every = turns.select("conv_id").distinct().select(F.col("conv_id").alias("_id"))
    for other in (reports, digests):
        other = other.withColumnRenamed("conv_id", "_other")
        every = every.join(other, F.col("_id").eqNullSafe(F.col("_other")), "left").drop("_other")
    nothing = hashlib.sha256(b"").hexdigest()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.select(
        F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
