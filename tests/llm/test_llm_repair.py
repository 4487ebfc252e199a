"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from llm_helpers import CLASHES
from pyspark.sql import functions as F

from placeframe.llm.repair import END, MOVES, Repair, Survivors, damaged, repair_damaged

GOOD = re.compile(r"(s?(ua)+)?")
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def exhaustive(rows):
    """Cheapest edits of rows (initial, gone, cut) by trying all, at most two inserts in one place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(gone and e != "D" for e, (_, gone, _) in zip(edits, rows)):
            continue
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            cost = 2 * sum(inserts) + sum(3 if e == "D" else 2 * (e == "R") + cut for e, (_, _, cut) in zip(edits, rows))
            audit = "".join("I" * k + e for k, e in zip(inserts, [*edits, ""]))
            if best is not None and (cost, audit) >= best:
                continue
            fixed = [i for e, (i, _, _) in zip(edits, rows) if e != "D" for i in [i if e == "K" else "x"]]
            length = sum(inserts) + len(fixed)
            roles = ("s" if length % 2 else "") + "ua" * (length // 2)
            kept = iter(fixed)
            if GOOD.fullmatch(roles) and all(c == "I" and r in "ua" or c == "R" and next(kept) and r in "ua" or c == "K" and next(kept) == r for c, r in zip(audit.replace("D", ""), roles)):
                best = (cost, audit)
    return best


def plain(rows):
    """The same by keeping the whole way to each state."""
    best = {0: (0, b"")}
    for i, gone, cut in [*rows, (None, None, None)]:
        new = {}
        for a, b, cost, edits in END if i is None else MOVES[i if i in "sua" else "", gone, cut]:
            if a in best:
                way = (best[a][0] + cost, best[a][1] + edits)
                new[b] = min(new.get(b, way), way)
        best = new
    return best[0][0], best[0][1].decode()


def searched(rows):
    run = Survivors()
    for i, gone, cut in rows:
        run.advance(MOVES[i if i in "sua" else "", gone, cut])
    run.advance(END)
    ((_, cost, edits),) = run.ways()
    return cost, edits.decode()


def test_against_all_edits():
    r = random.Random(1)
    for n in range(4):
        for _ in range(40):
            rows = [(r.choice("suat"), r.random() < 0.2, r.random() < 0.3) for _ in range(n)]
            assert exhaustive(rows) == plain(rows) == searched(rows), rows


def test_long_ones_against_whole_ways():
    r = random.Random(2)
    for _ in range(600):
        roles = r.choice(["suat", "ua", "uuuut", "t", "s", "ssua"])
        rows = [(r.choice(roles), r.random() < r.choice([0, 0.3, 0.9]), r.random() < 0.3) for _ in range(r.randrange(40))]
        assert plain(rows) == searched(rows), rows


def test_memory_follows_the_open_edits():
    run = Survivors()
    for i in range(20_000):
        run.advance(MOVES["ua"[i % 2], False, i % 7 == 0])
        assert run.nodes() < 12 and len(run._open(max(run.best.values(), key=lambda w: w[0])[1])) < 8
    assert len(run.emitted) > 19_990
    blank = Survivors()  # never decided until a row stays: one node for each way
    blank.advance(MOVES["s", False, False])
    for _ in range(5_000):
        blank.advance(MOVES["u", True, False])
        assert blank.nodes() < 6


def word(x):
    return " " if x is None else str(x)


def brute(rows):
    """Every contract column of rows (conv, turn, role, text), one conversation after another."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            fault = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20
            role, text = word(role), word(text)
            if fault:
                text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
                kept += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
        who = lambda role, text: hashlib.sha256(f"{'true' if conv is None else 'false'}{len('' if conv is None else str(conv))}:{'' if conv is None else conv}{len(role)}:{role}{text}".encode()).hexdigest()  # noqa: E731, B023
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, who(r[1], r[2])))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in kept:
            signs = SPACE.findall(text)
            kind = 0 if not signs else 1 if (role, text) in seen else 2 if signs[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                counts[kind] += 1
            judged.append((role[:1], kind in (0, 1), kind == 2))
        cost, audit = plain(judged)
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        length = len(audit.replace("D", ""))
        roles = (["s"] if length % 2 else []) + ["user", "assistant"] * (length // 2)
        lines, left = [], iter(kept)
        for e in audit:
            row = next(left) if e != "I" else (None, None, "")
            if e != "D":
                lines.append((row[1] if e == "K" else roles[len(lines)]) + ":" + row[2])
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def table(spark):
    r = random.Random(3)
    says = ["Yes.", "no", "", " \t", "What?", "A long answer. It ends!", "fin. ", "déjà vu.", None]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", "", None]), r.choice(says)) for c in range(60) for t in range(r.randrange(9))]
    rows += [(c, t, ["user", "assistant"][t % 2], f"Turn {t}.") for c in range(100, 130) for t in range(8)]
    rows += [(None, t, "user", "Hm.") for t in (None, None, 3)] + [(5, None, "assistant", "Late."), (7, 2, "user", "x" * 200_000 + "."), (7, 2, "user", "Same turn.")]
    rows += [(900, t, r.choice(["user", "assistant", "tool"]), r.choice([*says, f"Own words {t}."])) for t in range(1_500)]  # two thirds of all rows
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *(F.lit("clash").alias(c) for c in [*CLASHES, "conv", "part", "a.b"]))


@pytest.fixture(params=["one part", "many parts"])
def cut(request, spark):
    """With many parts the long conversation lies in several of them."""
    names = ["spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n) for n in names]
    if request.param == "many parts":
        spark.conf.set(names[0], "false")
        spark.conf.set(names[1], "9")
    yield request.param
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_query_against_plain_search(spark, cut):
    rows, df = table(spark)
    got = repair_damaged(df.repartition(6)).collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r[n] for n in names) for r in got} == brute(rows)
    assert len(got) == len({r[0] for r in rows})


def test_repaired_rows(spark, cut):
    rows, df = table(spark)
    repair = Repair(damaged(df))
    parts = repair.rows.filter("conv = 900").select("part").distinct().count()
    assert parts > 4 if cut == "many parts" else parts == 1
    sums = {r.conv_id: r.repaired_sha256 for r in repair.digests().collect()}
    found = {}
    for r in sorted(repair.repaired().filter("conv_id is not null").collect(), key=lambda r: (r.conv_id, r["index"])):
        found.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, lines in found.items():
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == sums[conv]
        assert GOOD.fullmatch("".join(x[0] for x in lines))


def test_empty_table_and_nothing_left(spark):
    _, df = table(spark)
    assert repair_damaged(df.limit(0)).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = repair_damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")).collect()
    assert (row.gaps, row.blank, row.cost, row.audit, row.repaired_sha256) == (0, 0, 0, "", hashlib.sha256().hexdigest())
