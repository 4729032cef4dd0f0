"""Conversation repair against a sequential search over whole conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from folioflow.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def sequential(rows):
    """All counts, the cheapest cost and the least audit of rows in order, by plain recursion over prefixes of edits."""
    faults, seen = [], set()
    for role, text in rows:
        end = text.rstrip(SPACE)
        if not end:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = {("", ()): (0, "")}  # (role initials so far reduced to a state, none) -> cheapest, least
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    ways = {"": (0, "", ())}
    del best

    def better(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        out = dict(ways)
        for _ in range(4):
            for state, (cost, audit, lines) in list(out.items()):
                role = "a" if state == "u" else "u"
                better(out, role, (cost + 2, audit + "I", (*lines, ("user" if role == "u" else "assistant", ""))))
        return out

    for (role, text), fault in zip(rows, faults, strict=True):
        now, extra = {}, int(fault == "truncated")
        for state, (cost, audit, lines) in inserted(ways).items():
            better(now, state, (cost + 3, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            if role[:1] and role[:1] in follow[state]:
                better(now, role[0], (cost + extra, audit + "K", (*lines, (role, text))))
            other = "a" if state == "u" else "u"
            better(now, other, (cost + 2 + extra, audit + "R", (*lines, ("user" if other == "u" else "assistant", text))))
        ways = now
    cost, audit, lines = min(way for state, way in inserted(ways).items() if state in ("", "a"))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def made(seed, conversations, turns):
    pick = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(pick.randrange(1, turns)):
            role = pick.choice(["system", "user", "assistant", "assistant", "user", "tool", "", "sam"])
            rows.append((conv, turn, role, pick.choice(["Fine.", "Good!", "cut off", " \n", "", f"Text {turn}? ", f"cut {turn}"])))
    return rows


def check(got, rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role, text))
    assert {r.conv_id for r in got} == set(by) and len(got) == len(by)
    for r in got:
        want = sequential([(role, text) for _, role, text in sorted(by[r.conv_id], key=lambda x: x[0])])
        assert (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == want


@pytest.mark.parametrize("width", [1, 7, 40])
def test_equals_the_sequential_search_over_any_number_of_chunks(spark, width):
    rows = made(width, 60, 12) + [(1000 + c, t, r, x) for c, t, r, x in made(9, 2, 400)]
    pick = random.Random(0)
    pick.shuffle(rows)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = repair.repair(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    check(got, rows)


def test_fix_ups_change_speculative_costs(spark):
    """A run of rows that agree whatever follows only after some time: the vectors differ by more than a constant at first."""
    rows = [(5, t, "user", f"Text {t}.") for t in range(101)]
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 10)
    try:
        frame = spark.createDataFrame(rows, SCHEMA)
        chunks = repair._converged(repair._faults(repair.materialise(repair._ordered(frame, "conv_id", "turn", "role", "text"), "t"))).collect()
        got = repair.repair(frame, "conv_id", "turn", "role", "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert len(chunks) > 3 and any(tuple(c.assumed) != repair.FINAL for c in chunks)
    check(got, rows)


def test_costs_that_never_agree_take_no_more_passes(spark, monkeypatch):
    """Rows of no legal role exchange two states for ever: pass after pass would mend one chunk only."""
    rows = [(5, t, "tool", f"Text {t}.") for t in range(401)] + [(6, t, "tool", "Same.") for t in range(300)]
    runs, usual, width = [], repair.materialise, spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(repair, "materialise", lambda frame, name: runs.append(name) or usual(frame, name))
    spark.conf.set("spark.sql.shuffle.partitions", 30)
    try:
        got = repair.repair(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", width)
    check(got, rows)
    assert "repair-costs" in runs and runs.count("repair-fixed") <= 2


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "A."), (None, 1, "user", "A."), (7, None, "user", "B"), (7, None, "user", "B"), (8, 5, "é", "x!")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], f"{SCHEMA}, pos long").withColumnRenamed("pos", "c")
    got = {r.conv_id: r for r in repair.repair(frame, "conv_id", "turn", "role", "text").collect()}
    assert (got[None].gaps, got[None].blank, got[None].duplicate, got[None].audit) == (1, 1, 1, "DKDI")
    assert (got[7].gaps, got[7].duplicate, got[7].truncated, got[7].cost) == (0, 1, 1, 6) and got[7].audit == "DD"
    assert (got[8].audit, got[8].cost) == ("D", 3)
    assert repair.repair(frame.limit(0), "conv_id", "turn", "role", "text").count() == 0


def test_lines_are_the_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Well?"), (1, 2, "system", "No."), (2, 0, "user", "")]
    got = repair.lines(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text").orderBy("conv_id", "place", "part").collect()
    kept = [(r.conv_id, r.role, r.text) for r in got]
    [row] = [r for r in repair.repair(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text").collect() if r.conv_id == 1]
    assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in kept).encode()).hexdigest() == row.repaired_sha256
    assert len(kept) % 2 == 0 and all(c == 1 for c, _, _ in kept)


def test_query_equals_the_sequential_search(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left, every = [], {r[0] for r in rows}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else text.translate(str.maketrans("", "", ".!?")) if fault == 2 else text
        left += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    got = queries.op11_repair(spark, sf_dir).collect()
    assert {r.conv_id for r in got} == every and len(got) == len(every)
    some = {r[0] for r in left}
    check([r for r in got if r.conv_id in some], left)
    for r in got:
        turns = {t for c, t, _, _ in left if c == r.conv_id and t is not None}
        assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        if r.conv_id not in some:
            assert (r.cost, r.audit, r.repaired_sha256) == (0, "", hashlib.sha256(b"").hexdigest())
