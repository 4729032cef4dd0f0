"""Conversation structure repair by a Viterbi search that runs in parallel along a conversation.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``. Rows are
kept (0), given the role user or assistant (2) or deleted (3), and empty user or assistant
turns may be inserted anywhere (2); blank and repeated rows must go, and a truncated row that
stays costs 1 more. The repair is the cheapest; among equally cheap ones that whose audit, the
initials of its edits in order (D, I, K, R), is least.

The search knows four states: nothing yet, after a system, a user, an assistant turn. All rows
are range-sorted, and what a partition holds of a conversation is one chunk. Every chunk runs
backwards from a speculative vector of costs to go. Fix-up passes rerun the chunks whose
successor turned out otherwise, along with their earlier run, until both vectors differ only by
a constant: from there on the earlier run stands, with that constant added. When no chunk
changes any more the backward costs are stitched. Each chunk also tells, for all four states,
in which one it ends; chained, these give every chunk its first state, and within a chunk the least edit on a cheapest way is traced row by row. A conversation
of any length, a third of all rows included, is thus worked on by many tasks; only its digest,
SHA-256 being sequential, is streamed by one task, which holds no text but the row at hand.

Rows are taken by turn, NULL first; rows of one turn by role, then a
hash of the text. NULL roles and texts
count as empty. Rows of a NULL conversation are one conversation. Rows alike in everything are
repeats. Roles of other initials than s, u, a can only be given a role or deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.store import materialise, shuffle_width

SPACE = " \t\n\x0b\f\r"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
INITIALS = "sua"
RENAME, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
#: State after an initial, by state; states count nothing yet, after system, user, assistant.
KEPT = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {}}
#: State after an inserted or renamed turn: only one role can follow.
NEXT = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}
#: Costs to go after the last row: open states are closed by insertions.
FINAL = (0, 4, 2, 0)
LAST_POS = (1 << 63) - 1

#: What a chunk is, and what its last run found.
CHUNK = {
    "c": pa.string(), "part": pa.int64(), "n": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(), "truncated": pa.int64(),
    "illegal": pa.int64(), "first": pa.int32(), "last": pa.int32(), "turns": pa.int64(), "low": pa.int64(), "high": pa.int64(),
}
RUN = {"assumed": pa.list_(pa.int32()), "start": pa.list_(pa.int32()), "gain": pa.int64(), "ends": pa.list_(pa.int32())}
KEY = {"c": pa.string(), "part": pa.int64()}
DDL = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<long>",
       pa.list_(pa.string()): "array<string>"}
EDIT = {"c": pa.string(), "pos": pa.int64(), "audit": pa.string(), "inserted": pa.list_(pa.string()), "renamed": pa.string()}
NEVER = 1 << 40


class Moves:
    """The step over one row, remembered by its code and the costs after it."""

    def __init__(self) -> None:
        self.known: dict = {}

    def __call__(self, initial: int, fault: int, after: tuple) -> tuple[tuple, int, tuple]:
        """Costs before the row less their least, that least, and per state (edits, next state)."""
        key = (initial, fault, after)
        if key not in self.known:
            self.known[key] = self._step(*key)
        return self.known[key]

    @staticmethod
    def _step(initial: int, fault: int, after: tuple) -> tuple[tuple, int, tuple]:
        extra = CUT_OFF if fault == TRUNCATED else 0
        ways = []
        for state in range(4):
            way = {"D": (DELETE + after[state], state)}
            if fault not in (BLANK, DUPLICATE):
                if state in KEPT[initial]:
                    way["K"] = (extra + after[KEPT[initial][state]], KEPT[initial][state])
                way["R"] = (RENAME + extra + after[NEXT[state]], NEXT[state])
            ways.append(way)
        cost = [min(c for c, _ in way.values()) for way in ways]
        for _ in range(3):
            cost = [min(c, INSERT + cost[NEXT[s]]) for s, c in enumerate(cost)]
        edits = []
        for state in range(4):
            audit = ""
            while True:
                here = ways[state] | {"I": (INSERT + cost[NEXT[state]], NEXT[state])}
                letter = min(x for x, (c, _) in here.items() if c == cost[state])
                audit += letter
                state = here[letter][1]
                if letter != "I":
                    break
            edits.append((audit, state))
        least = min(cost)
        return tuple(c - least for c in cost), least, tuple(edits)


def repair(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: its gaps, faults, cheapest cost, audit and repaired digest.

    ``gaps`` counts the turn numbers missing between the least and the greatest; ``illegal``
    the neighbours whose initials are not su, ua or au. See the module for the rest.
    """
    table = materialise(_ordered(rows, conv, turn, role, text), "repair-rows")
    codes = materialise(_faults(table), "repair-codes")
    chunks = _converged(codes)
    digests = _digests(table, _edits(codes, chunks))
    return digests.join(_totals(chunks), "c").drop("c").withColumnRenamed("conv", conv)


def lines(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The repaired rows: conversation, place, role, text, in the audit's order by (place, part).

    Inserted turns come before the row at their place; those at the end have the greatest place.
    """
    table = materialise(_ordered(rows, conv, turn, role, text), "repair-rows")
    codes = materialise(_faults(table), "repair-codes")
    edits = _edits(codes, _converged(codes))
    conversations = table.groupBy("c").agg(F.first("conv").alias(conv))
    added = edits.select("c", "pos", F.posexplode("inserted").alias("part", "role"), F.lit("").alias("text"))
    kept = edits.where(~F.col("audit").endswith("D") & ~F.col("audit").endswith("I")).join(table.drop("c"), "pos").select(
        "c", "pos", F.size("inserted").alias("part"), F.coalesce("renamed", "role").alias("role"), "text"
    )
    return added.union(kept).join(conversations, "c").select(conv, F.col("pos").alias("place"), "part", F.col("role").alias(role), F.col("text").alias(text))


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in global order with their place; equal rows may be parted anywhere."""
    key = F.when(F.col(conv).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(conv).cast("string")))
    plain = rows.select(
        key.alias("c"), F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("_tie", F.monotonically_increasing_id())
    order = ["c", "turn", "role", F.xxhash64("text"), "_tie"]
    ranged = plain.repartitionByRange(shuffle_width(rows.sparkSession), *order).sortWithinPartitions(*order)
    return ranged.withColumn("pos", F.monotonically_increasing_id()).drop("_tie")


def _faults(table: DataFrame) -> DataFrame:
    """(c, part, pos, turn, initial, fault): each row's first fault."""
    end = F.rtrim("text", F.lit(SPACE))
    coded = table.select(
        "c", "pos", "turn", F.shiftright("pos", 33).alias("part"),
        (F.position(F.substring("role", 1, 1), F.lit(INITIALS)) - 1).alias("at"), F.length(F.substring("role", 1, 1)).alias("named"),
        F.when(end == "", BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND).alias("fault"),
        F.sha2(F.concat_ws("\x00", F.sha2("role", 256), F.sha2("text", 256)), 256).alias("same"),
    ).withColumn("initial", F.when((F.col("named") == 1) & (F.col("at") >= 0), F.col("at")).otherwise(3).cast("int"))
    firsts = coded.groupBy("c", "same").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    repeated = F.col("new").isNull() & (F.col("fault") != BLANK)
    return coded.join(firsts, "pos", "left").select(
        "c", "part", "pos", "turn", "initial", F.when(repeated, DUPLICATE).otherwise(F.col("fault")).cast("int").alias("fault")
    )


def _ddl(fields: dict) -> str:
    return ", ".join(f"{name} {DDL[kind]}" for name, kind in fields.items())


def _batch(rows: list[tuple], fields: dict) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(columns, fields.values(), strict=True)], names=list(fields))


def _vector(values: tuple) -> Column:
    return F.array(*map(F.lit, values))


def _backwards(codes: DataFrame, width: int | None = None) -> DataFrame:
    """Rows of each chunk together, the last one first."""
    width = width or shuffle_width(codes.sparkSession)
    return codes.repartition(width, "c", "part").sortWithinPartitions("c", "part", F.desc("pos"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, int, int, pa.RecordBatch]]:
    """Runs of rows of one chunk: its key, the rows' range and their batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names, parts = batch["c"].to_numpy(zero_copy_only=False), batch["part"].to_numpy()
        cuts = np.flatnonzero((names[1:] != names[:-1]) | (parts[1:] != parts[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield (names[a], int(parts[a])), a, b, batch


def _values(batch: pa.RecordBatch, a: int, b: int, *names: str) -> Iterator[tuple]:
    return zip(*(batch[name].slice(a, b - a).to_pylist() for name in names), strict=True)


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every chunk run backwards from the costs after a last row, with its counts."""
    moves, now, found = Moves(), None, []
    legal = {(0, 1), (1, 2), (2, 1)}

    def close() -> tuple:
        return (*now, sum(counts), *counts[1:], illegal, following, last, turns, low, high, list(FINAL), list(costs), gain, ends)

    for key, a, b, batch in _stretches(batches):
        if key != now:
            if now is not None:
                found.append(close())
            now, costs, gain, ends = key, FINAL, 0, [0, 1, 2, 3]
            counts, illegal, following, last, turns, low, high = [0] * 4, 0, None, None, 0, None, None
        for turn, initial, fault in _values(batch, a, b, "turn", "initial", "fault"):
            costs, least, edits = moves(initial, fault, costs)
            gain += least
            ends = [ends[state] for _, state in edits]
            counts[fault] += 1
            if following is None:
                last = initial
            else:
                illegal += (initial, following) not in legal
            following = initial
            if turn is not None and turn != low:
                turns += 1
                low, high = turn, turn if high is None else high
        if len(found) >= 4096:
            yield _batch(found, CHUNK | RUN)
            found = []
    if now is not None:
        found.append(close())
    yield _batch(found, CHUNK | RUN)


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks run again from their successor's costs, beside their earlier run until both agree.

    From there on only the chain of states is drawn further.
    """
    moves, now, found = Moves(), None, []

    def close() -> tuple:
        if met:
            return (*now, list(wanted), earlier["start"], gain + earlier["gain"] - old_gain, ends)
        return (*now, list(wanted), list(costs), gain, ends)

    for key, a, b, batch in _stretches(batches):
        if key != now:
            if now is not None:
                found.append(close())
            earlier = {k: batch[k][a].as_py() for k in ("wanted", "assumed", "start", "gain")}
            now, wanted, gain, old_gain, met, ends = key, tuple(earlier["wanted"]), 0, 0, False, [0, 1, 2, 3]
            costs, old = wanted, tuple(earlier["assumed"])
        for initial, fault in _values(batch, a, b, "initial", "fault"):
            costs, least, edits = moves(initial, fault, costs)
            ends = [ends[state] for _, state in edits]
            if not met:
                gain += least
                old, least, _ = moves(initial, fault, old)
                old_gain += least
                met = costs == old
    if now is not None:
        found.append(close())
    yield _batch(found, KEY | RUN)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's costs from every first to every last state: four runs, each from one certain last state."""
    moves, now, found = Moves(), None, []
    units = [tuple(0 if s == e else float("inf") for s in range(4)) for e in range(4)]

    def close() -> tuple:
        whole = [min(NEVER, cost + gain) for costs, gain in runs for cost in costs]
        return (*now, [int(cost) for cost in whole])

    for key, a, b, batch in _stretches(batches):
        if key != now:
            if now is not None:
                found.append(close())
            now, runs = key, [(unit, 0) for unit in units]
        for initial, fault in _values(batch, a, b, "initial", "fault"):
            runs = [(after, gain + least) for costs, gain in runs for after, least, _ in [moves(initial, fault, costs)]]
    if now is not None:
        found.append(close())
    yield _batch(found, KEY | {"matrix": pa.list_(pa.int64())})


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs each chunk ends in, from the last chunk of a conversation to its first."""
    now, costs, found = None, FINAL, []
    for batch in batches:
        for c, part, matrix in _values(batch, 0, batch.num_rows, "c", "part", "matrix"):
            now, costs = c, costs if c == now else FINAL
            found.append((c, part, list(costs)))
            before = [min(matrix[4 * e + s] + costs[e] for e in range(4)) for s in range(4)]
            costs = tuple(cost - min(before) for cost in before)
    yield _batch(found, KEY | {"wanted": pa.list_(pa.int32())})


def _converged(codes: DataFrame) -> DataFrame:
    """Every chunk with the costs it starts from and ends in, true along its conversation.

    Where a second pass would still meet unlike costs, as along rows that only exchange two
    states, the chunks' whole matrices are multiplied instead: the number of passes never
    depends on the number of chunks.
    """
    spark = codes.sparkSession
    chunks = materialise(_backwards(codes).mapInArrow(_speculate, _ddl(CHUNK | RUN)), "repair-chunks")
    order = Window.partitionBy("c").orderBy("part")
    rows = max(chunks.agg(F.sum("n")).first()[0] or 0, 1)

    def redone(wanted: DataFrame, function, fields: dict) -> DataFrame:
        """As many tasks as the chunks' share of all rows asks for."""
        share = (wanted.agg(F.sum("n")).first()[0] or 0) / rows
        some = _backwards(codes.join(wanted.drop("n"), ["c", "part"]), max(1, round(share * shuffle_width(spark))))
        return some.mapInArrow(function, _ddl(fields))

    for turn in range(3):
        linked = chunks.withColumn("wanted", F.coalesce(F.lead("start").over(order), _vector(FINAL)))
        wrong = linked.where("wanted != assumed").select("c", "part", "n", "wanted", "assumed", "start", "gain")
        if wrong.isEmpty():
            break
        if turn == 1:
            unlike = chunks.join(wrong.select("c").distinct(), "c", "left_semi")
            matrices = redone(unlike.select("c", "part", "n"), _matrices, KEY | {"matrix": pa.list_(pa.int64())})
            chained = matrices.repartition(shuffle_width(spark), "c").sortWithinPartitions("c", F.desc("part"))
            true = materialise(chained.mapInArrow(_multiplied, _ddl(KEY | {"wanted": pa.list_(pa.int32())})), "repair-costs")
            wrong = unlike.join(true, ["c", "part"]).where("wanted != assumed").select(*wrong.columns)
        again = materialise(redone(wrong, _fix_up, KEY | RUN), "repair-fixed")
        new = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in RUN]
        same = (F.col("o.c") == F.col("n.c")) & (F.col("o.part") == F.col("n.part"))
        joined = chunks.alias("o").join(again.alias("n"), same, "left")
        chunks = materialise(joined.select(*[f"o.{k}" for k in CHUNK], *new), "repair-chunks")
    return chunks


def _totals(chunks: DataFrame) -> DataFrame:
    order = Window.partitionBy("c").orderBy("part")
    before = F.lag("last").over(order)
    legal = ((before == 0) & (F.col("first") == 1)) | ((before == 1) & (F.col("first") == 2)) | ((before == 2) & (F.col("first") == 1))
    seam = F.when(before.isNotNull() & ~legal, 1).otherwise(0)
    known = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    turns = F.col("turns") - F.when(F.col("low") == known, 1).otherwise(0)
    return chunks.withColumns({"seam": seam, "own": turns}).groupBy("c").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("own"), F.lit(0)).alias("gaps"),
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.sum("seam")).alias("illegal"),
        (F.sum("gain") + F.min_by("start", "part")[0]).alias("cost"),
    )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state each chunk begins in, along the chunks of a conversation."""
    now, state = None, 0
    for batch in batches:
        begins = []
        for c, ends in _values(batch, 0, batch.num_rows, "c", "ends"):
            now, state = c, state if c == now else 0
            begins.append(state)
            state = ends[state]
        yield pa.RecordBatch.from_arrays([batch["c"], batch["part"], pa.array(begins, pa.int32())], names=["c", "part", "begin"])


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of every row; a chunk's steps are held, two numbers a row, then walked forwards."""
    moves, now = Moves(), None

    def walk() -> pa.RecordBatch:
        out, here = [], state
        for pos, edits in zip(reversed(places), reversed(steps), strict=True):
            audit, after = edits[here]
            inserted = []
            for _ in audit[:-1]:
                here = NEXT[here]
                inserted.append(NAMES[here])
            out.append((now[0], pos, audit, inserted, NAMES[after] if audit[-1] == "R" else None))
            here = after
        if last and FINAL[here]:
            inserted = ["user", "assistant"] if here == 1 else ["assistant"]
            out.append((now[0], LAST_POS, "I" * len(inserted), inserted, None))
        return _batch(out, EDIT)

    for key, a, b, batch in _stretches(batches):
        if key != now:
            if now is not None:
                yield walk()
            costs, state, last = (batch[k][a].as_py() for k in ("assumed", "begin", "ending"))
            now, costs, places, steps = key, tuple(costs), [], []
        places += batch["pos"].slice(a, b - a).to_pylist()
        for initial, fault in _values(batch, a, b, "initial", "fault"):
            costs, _, edits = moves(initial, fault, costs)
            steps.append(edits)
    if now is not None:
        yield walk()


def _edits(codes: DataFrame, chunks: DataFrame) -> DataFrame:
    """(c, pos, audit, inserted, renamed) of every row, and of what follows a last row."""
    order = Window.partitionBy("c").orderBy("part")
    placed = chunks.select(
        "c", "part", "assumed", "ends", F.lead("part").over(order).isNull().alias("ending"), F.lag("part").over(order).isNull().alias("opening")
    )
    # conversations of several chunks: at most two chunks a range partition, a few bytes each
    chained = placed.where("NOT (opening AND ending)").select("c", "part", "ends").repartition("c").sortWithinPartitions("c", "part")
    begins = chained.mapInArrow(_chained, "c string, part long, begin int")
    known = placed.join(begins, ["c", "part"], "left").select("c", "part", "assumed", "ending", F.coalesce("begin", F.lit(0)).alias("begin"))
    return materialise(_backwards(codes.join(known, ["c", "part"])).mapInArrow(_trace, _ddl(EDIT)), "repair-edits")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation from its edits, each followed by the row it means."""
    now, found = None, []

    def line(content: str) -> None:
        nonlocal begun
        digest.update((f"\n{content}" if begun else content).encode())
        begun = True

    for batch in batches:
        columns = ("c", "kind", "audit", "inserted", "role", "text")
        kinds = batch["conv"].type
        for k, (c, kind, step, inserted, role, text) in enumerate(_values(batch, 0, batch.num_rows, *columns)):
            if c != now:
                if now is not None:
                    found.append((now, conv, "".join(audit), digest.hexdigest()))
                now, audit, digest, begun, edit, conv = c, [], hashlib.sha256(), False, None, None
            if kind == 0:
                audit.append(step)
                for name in inserted:
                    line(f"{name}:")
                edit = (step[-1], role)
            else:
                conv = batch["conv"][k].as_py()
                if edit[0] != "D":
                    line(f"{edit[1] or role}:{text}")
    if now is not None:
        found.append((now, conv, "".join(audit), digest.hexdigest()))
        yield _batch(found, {"c": pa.string(), "conv": kinds, "audit": pa.string(), "repaired_sha256": pa.string()})


def _digests(table: DataFrame, edits: DataFrame) -> DataFrame:
    kind = table.schema["conv"].dataType.simpleString()
    none = F.lit(None).cast(kind)
    both = edits.select("c", none.alias("conv"), "pos", F.lit(0).alias("kind"), "audit", "inserted", F.col("renamed").alias("role"), F.lit("").alias("text")).union(
        table.select("c", "conv", "pos", F.lit(1).alias("kind"), F.lit("").alias("audit"), F.array().cast("array<string>").alias("inserted"), "role", "text")
    )
    dealt = both.repartition(shuffle_width(table.sparkSession), "c").sortWithinPartitions("c", "pos", "kind")
    return dealt.mapInArrow(_digest, f"c string, conv {kind}, audit string, repaired_sha256 string")
