"""Conversation structure repair by a checkpointed dynamic program.

A conversation's rows, in order, are kept, reroled or deleted, and empty rows
inserted, at least cost so that the role initials read ``(s?(ua)+)?``. The
state is the place in that pattern; ``step`` takes the cost vector behind a
row to the one before it.

Only block ends hold a backward cost vector (checkpoints). Rows are dealt by
range, so a conversation of any length spreads over tasks, in blocks of
``BLOCK`` rows: each block's steps are one min-plus matrix, the checkpoints
come from a backward pass over these matrices, and each block then recomputes
its own vectors from its checkpoint and walks forward, emitting the ASCII-least
tight edit. A block that is not its conversation's first walks from every
state; a forward pass over the blocks' exits picks the walk that took place. A
block is the square root of a million rows, so a task that passes over the
blocks of a conversation meets a thousandth of its rows.

Defined results: rows stand by turn (null first), then role, then text; equal
rows are one row and its copies. A null role or text is one space. A row
without conv_id belongs to the conversation null. Texts of any length count
whole. No rows give no rows. Other columns than the four are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import bounded_batches, byte_slices, materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows of a block.
BLOCK_BITS = 10
#: Blanks of the contract's row checks, and marks that end a whole text.
BLANKS, MARKS = " \t\n\x0b\x0c\r", ".!?"
#: Faults of a row.
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Place in the pattern: at the start, after s, after u, after a. By initial (s, u, a, other) where a row leads.
LEADS = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
#: Where an inserted or reroled row leads, and which role it takes.
FILLS, FILL = (2, 2, 3, 2), ("user", "user", "assistant", "user")
NEVER = 1 << 60
END = (0, 2 * INSERT, INSERT, 0)  # behind the last row: inserts alone

ORDER = ["conv_id", "turn", "role", "text"]  # nulls first


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the contract's faults put in, by crc32 of ``conv_id:turn`` modulo 20:
    0 gone, 1 emptied, 2 without marks, 3 twice, 4 role user. Columns: conv_id, turn, role, text, copies."""
    def said(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    key = F.concat(said("conv_id"), F.lit(":"), said("turn"))
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_k"))
    return rows.where("_k <> 0").select(
        "conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", MARKS, "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_k") == 3, 2).otherwise(1).cast("long").alias("copies"))


def as_given(conversations: DataFrame) -> DataFrame:
    """The rows as they stand, each one copy, in the columns ``repair`` takes."""
    return conversations.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
                                F.lit(1).cast("long").alias("copies"))


def ordered(rows: DataFrame) -> DataFrame:
    """Distinct rows with copies, fault, initial (0 s, 1 u, 2 a, 3 other), place
    ``at`` and ``block``, written in order. Equal rows meet summed per task, so
    no key or text gathers its rows anywhere."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("_said", F.unhex(F.sha2(F.concat_ws("\0", F.octet_length("role").cast("string"), "role", "text"), 256)))
    again = (rows.groupBy("conv_id", "_said").agg(F.count(F.lit(1)).alias("_n"), F.min("turn").alias("_first"), F.max(F.col("turn").isNull()).alias("_null"))
             .where("_n > 1").select(F.col("conv_id").alias("_conv"), F.col("_said").alias("_same"), "_first", "_null"))
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_said") == F.col("_same")), "left")
    later = F.coalesce(F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_first")), F.lit(False))
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = F.when(last == "", BLANK).when(later, DUPLICATE).when(~last.isin(*MARKS), CUT).otherwise(SOUND)
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    rows = rows.select("conv_id", "turn", "role", "text", "copies", fault.cast("int").alias("fault"), initial.cast("int").alias("initial"))
    rows = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("at", F.monotonically_increasing_id())
    return materialize(rows.withColumn("block", F.shiftright("at", BLOCK_BITS)), "repair-rows")


def step(after, initial: int, fault: int, copies: int):
    """Cost vector before a row (with inserts there) from the one behind it."""
    cost = [v + DELETE * copies for v in after]
    if fault not in (BLANK, DUPLICATE):
        more = DELETE * (copies - 1) + TRUNCATED * (fault == CUT)
        for s in range(4):
            to = LEADS[s][initial]
            cost[s] = min(cost[s], after[FILLS[s]] + REROLE + more, after[to] + KEEP + more if to is not None else NEVER)
    return filled(cost)


def filled(cost):
    """``cost`` when rows may be inserted first."""
    cost[2], cost[3] = min(cost[2], cost[3] + INSERT), min(cost[3], cost[2] + INSERT)
    cost[0], cost[1] = min(cost[0], cost[2] + INSERT), min(cost[1], cost[2] + INSERT)
    return cost


def matrix(rows) -> list[int]:
    """Least cost from each state before the rows (major) to each state behind them."""
    columns = []
    for end in range(4):
        v = [NEVER] * 4
        v[end] = 0
        for row in reversed(rows):
            v = step(v, *row)
        columns.append(v)
    return [min(NEVER, columns[e][s]) for s in range(4) for e in range(4)]


def walk(rows, end, entry: int, last: bool):
    """(exit state, plan of each row) from ``entry``: the ASCII-least tight edits
    (D < I < K < R). A plan has a character for each edit: K and D; U and A for
    an inserted user or assistant, V and B for a row that becomes one."""
    vectors = [list(end)]
    for row in reversed(rows):
        vectors.append(step(vectors[-1], *row))
    vectors.reverse()
    state, plans = entry, []
    for before, after, (initial, fault, copies) in zip(vectors, vectors[1:], rows):
        plan = ""
        while True:
            must, rest = before[state], after
            if rest[state] + DELETE * copies == must:
                plan += "D" * copies
                break
            if before[FILLS[state]] + INSERT == must:
                plan += "A" if state == 2 else "U"
                state = FILLS[state]
                continue
            more = DELETE * (copies - 1) + TRUNCATED * (fault == CUT)
            to = LEADS[state][initial]
            if to is not None and rest[to] + KEEP + more == must:
                plan, state = plan + "K", to
            else:
                plan, state = plan + ("B" if state == 2 else "V"), FILLS[state]
            plan += "D" * (copies - 1)
            break
        plans.append(plan)
    while last and END[state]:
        plans[-1] += "A" if state == 2 else "U"
        state = FILLS[state]
    return state, plans


def _stream(batches, names):
    """Rows of the batches as tuples of ``names``."""
    for batch in batches:
        yield from zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


def _emit(found, types: dict, at_once: int = 8192):
    """Batches of the tuples in ``found``."""
    held = []
    for row in found:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.values())], names=list(types))
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types.values())], names=list(types))


def _by_conversation(df: DataFrame, *order):
    """Dealt by conversation, each one's rows together and in order."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


LONGS, CONV = pa.list_(pa.int64()), pa.int64()


def blocks(rows: DataFrame) -> DataFrame:
    """One row per conversation and block: its first place, its rows' codes and matrix."""
    unit = F.struct("at", "initial", "fault", "copies")
    packed = rows.groupBy("conv_id", "block").agg(F.array_sort(F.collect_list(unit)).alias("u"))  # 2 ** BLOCK_BITS rows at most
    packed = packed.select("conv_id", "block", F.col("u")[0]["at"].alias("first"), *[F.col(f"u.{c}").alias(c) for c in ("initial", "fault", "copies")])
    types = {"conv_id": CONV, "block": CONV, "first": CONV, "initial": pa.list_(pa.int32()), "fault": pa.list_(pa.int32()), "copies": LONGS, "matrix": LONGS}

    def run(batches):
        names = list(types)[:-1]
        return _emit(((*row, matrix([*zip(*row[3:])])) for row in _stream(batches, names)), types)

    return materialize(packed.mapInArrow(run, "conv_id long, block long, first long, initial array<int>, fault array<int>, copies array<long>, matrix array<long>"), "repair-blocks")


def checkpoints(blocks: DataFrame) -> DataFrame:
    """The cost vector behind each block, from the last block backward, and
    whether the block is its conversation's first or last."""
    def run(batches):
        def passed():
            conv, vector, held = None, None, None
            for new, block, m in _stream(batches, ("conv_id", "block", "matrix")):
                same = held is not None and new == conv
                if held is not None:
                    yield (*held, not same)
                if not same:
                    conv, vector = new, list(END)
                held = (new, block, vector, not same)
                vector = [min(m[4 * s + e] + vector[e] for e in range(4)) for s in range(4)]
            if held is not None:
                yield (*held, True)

        return _emit(passed(), {"conv_id": CONV, "block": CONV, "behind": LONGS, "is_last": pa.bool_(), "is_first": pa.bool_()})

    return _by_conversation(blocks.select("conv_id", "block", "matrix"), F.desc("block")).mapInArrow(
        run, "conv_id long, block long, behind array<long>, is_last boolean, is_first boolean")


def walks(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """Each block's exit state and plans from each state it may be entered in."""
    ends = ends.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "behind", "is_last", "is_first")
    rows = blocks.drop("matrix").join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    names = ["conv_id", "block", "first", "initial", "fault", "copies", "behind", "is_last", "is_first"]
    types = {"conv_id": CONV, "block": CONV, "first": CONV, "exits": LONGS, "plans": pa.list_(pa.list_(pa.string()))}

    def run(batches):
        def all_of():
            for conv, block, first, initial, fault, copies, behind, is_last, is_first in _stream(batches, names):
                ways = [walk([*zip(initial, fault, copies)], behind, s, is_last) for s in range(1 if is_first else 4)]
                yield conv, block, first, [w[0] for w in ways], [w[1] for w in ways]
        return _emit(all_of(), types, 256)

    return materialize(rows.select(*names).mapInArrow(run, "conv_id long, block long, first long, exits array<long>, plans array<array<string>>"), "repair-walks")


def entries(walked: DataFrame) -> DataFrame:
    """The state in which each block is entered, from the first block on."""
    def run(batches):
        def passed():
            conv, state, begun = None, 0, False
            for new, block, exits in _stream(batches, ("conv_id", "block", "exits")):
                if not begun or new != conv:
                    conv, state, begun = new, 0, True
                yield new, block, state
                state = exits[state]
        return _emit(passed(), {"conv_id": CONV, "block": CONV, "entry": CONV})

    return _by_conversation(walked.select("conv_id", "block", "exits"), "block").mapInArrow(run, "conv_id long, block long, entry long")


def plans(rows: DataFrame) -> DataFrame:
    """``ordered`` rows with the ``plan`` of each (see ``walk``)."""
    packed = blocks(rows)
    walked = walks(packed, checkpoints(packed))
    entered = entries(walked).select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "entry")
    chosen = walked.join(entered, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    each = chosen.select("first", F.posexplode(F.col("plans")[F.col("entry").cast("int")]).alias("_i", "plan"))
    return rows.drop("block").join(each.select((F.col("first") + F.col("_i")).alias("at"), "plan"), "at")


def repair(rows: DataFrame) -> DataFrame:
    """The edits of damaged rows (conv_id, turn, role, text, copies), one row each:
    conv_id, at, step (order: at, step), edit (Keep, Rerole, Delete, Insert by
    initial), role and text behind it (null when deleted), turn (null when inserted)."""
    done = plans(ordered(rows)).withColumn("n", F.length("plan"))
    done = done.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("step")).withColumn("e", F.expr("substring(plan, step, 1)"))
    inserted, gone = F.col("e").isin("U", "A"), F.col("e") == "D"
    role = F.when(F.col("e").isin("U", "V"), "user").when(F.col("e").isin("A", "B"), "assistant").when(F.col("e") == "K", F.col("role"))
    return done.select("conv_id", "at", "step", F.translate("e", "UAVB", "IIRR").alias("edit"), role.alias("role"),
                       F.when(inserted, "").when(~gone, F.col("text")).alias("text"), F.when(~inserted, F.col("turn")).alias("turn"))


class Sum:
    """What the digest of one conversation adds up, row by row in order."""

    __slots__ = ("conv", "low", "high", "turns", "seen", "counts", "cost", "audit", "sha", "lines", "before")

    def __init__(self, conv):
        self.conv, self.low, self.high, self.turns, self.seen = conv, None, None, 0, None
        self.counts, self.cost, self.audit, self.sha, self.lines, self.before = [0, 0, 0, 0], 0, [], hashlib.sha256(), 0, None

    def line(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.lines else "") + role + ":" + text).encode())
        self.lines += 1

    def add(self, turn, role, text, copies, fault, plan) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial, counts = role[:1], self.counts
        counts[0] += copies * (fault == BLANK)
        counts[1] += copies if fault == DUPLICATE else (copies - 1) * (fault != BLANK)
        counts[2] += fault == CUT
        counts[3] += (self.before is not None and self.before + initial not in ("su", "ua", "au")) + (copies - 1)
        self.before = initial
        for e in plan:
            if e == "D":
                self.cost += DELETE
            elif e in "UA":
                self.cost += INSERT
                self.line("user" if e == "U" else "assistant", "")
            else:
                self.cost += (KEEP if e == "K" else REROLE) + TRUNCATED * (fault == CUT)
                self.line(role if e == "K" else "user" if e == "V" else "assistant", text)
        self.audit.append(plan.translate(LETTERS))

    def row(self):
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.counts, self.cost, "".join(self.audit), self.sha.hexdigest())


LETTERS = str.maketrans("UAVB", "IIRR")


def digests(conversations: DataFrame) -> DataFrame:
    """Damage and repair every conversation: its fault counts, cost, audit and the
    SHA-256 of its repaired lines. A SHA-256 runs over its text in order, so here
    (and only here) a conversation's rows pass one task, as a stream, unkept."""
    spark = conversations.sparkSession
    bounded_batches(spark)
    done = plans(ordered(damage(conversations)))
    names = ["conv_id", "turn", "role", "text", "copies", "fault", "plan"]
    types = {"conv_id": CONV, "gaps": CONV, "blank": CONV, "duplicate": CONV, "truncated": CONV, "illegal": CONV, "cost": CONV, "audit": pa.string(), "repaired_sha256": pa.string()}

    def run(batches):
        def summed():
            now = None
            for batch in batches:
                for conv, *row in (r for part in byte_slices(batch, "text") for r in _stream([part], names)):
                    if now is None or now.conv != conv:
                        if now is not None:
                            yield now.row()
                        now = Sum(conv)
                    now.add(*row)
            if now is not None:
                yield now.row()
        return _emit(summed(), types, 256)

    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    result = _by_conversation(done.select(*names, "at"), "at").select(*names).mapInArrow(
        run, "conv_id long, " + ", ".join(f"{c} long" for c in longs) + ", audit string, repaired_sha256 string")
    all_ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    out = all_ids.join(result, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in longs],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
