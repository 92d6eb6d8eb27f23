"""Conversation repair against SQL, and the dynamic program against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA

pytest.importorskip("lakevec.llm")
from lakevec.llm import turns  # noqa: E402

ROLES = {"s": "system", "u": "user", "a": "assistant"}
GOAL = re.compile("(s?(ua)+)?$")


def searched(rows, most=60):
    """(cost, audit, repaired) of rows (role, text, fault) by best-first search over whole edit sequences."""
    todo, done = [(0, "", 0, "")], set()
    while todo:
        cost, audit, i, roles = heapq.heappop(todo)
        if i == len(rows) and GOAL.match(roles):
            break
        if (i, roles[-1:], len(roles) == 1) in done:
            continue
        done.add((i, roles[-1:], len(roles) == 1))
        more = [(3, "I", i, r) for r in "ua"]
        if i < len(rows):
            role, _, fault = rows[i]
            extra = 3 if fault == "truncated" else 0
            more.append((4, "D", i + 1, ""))
            if fault not in ("blank", "duplicate"):
                more += [(extra, "K", i + 1, role[:1] or "?"), *((3 + extra, "R", i + 1, r) for r in "ua")]
        for c, edit, j, r in more:
            now = roles + r
            if re.match("s?(ua)*u?$", now):  # can still become what it must be
                heapq.heappush(todo, (cost + c, audit + edit, j, now))
    out, i, roles = [], 0, ""
    for edit in audit:
        role, text, _ = rows[i] if edit != "I" else ("", "", "")
        i += edit != "I"
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if roles[-1:] == "u" else "user"
        out.append(f"{role}:{text}")
        roles += role[:1]
    return cost, audit, "\n".join(out)


def plain(rows):
    """The query's result by hand: rows are (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c != conv:
                continue
            role, text = (" " if x is None else x for x in (role, text))
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        known, faulty = set(), []
        for _, role, text in mine:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in known else "truncated" if body[-1] not in ".!?" else ""
            known.add((role, text))
            faulty.append((role, text, fault))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        count = lambda f: sum(x[2] == f for x in faulty)  # noqa: B023, E731
        illegal = sum((a[0][:1], b[0][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(faulty, faulty[1:]))  # noqa: B905
        cost, audit, text = searched(faulty)
        out[conv] = (conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, oracle, scale):
    got = turns.repair_table(spark.read.parquet(f"{DATA}/{scale}/conversations.parquet"))
    columns, want = oracle(turns.ORACLE_SQL, scale)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(want)


@pytest.mark.parametrize("seed", range(4))
def test_repairs_are_the_cheapest(seed):
    r, repairer = random.Random(seed), turns.Repairer()
    faults = {"": turns.NONE, "blank": turns.BLANK, "duplicate": turns.DUPLICATE, "truncated": turns.CUT}
    for _ in range(300):
        rows = [(r.choice(["user", "assistant", "system", "tool", ""]), "x", r.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(r.randint(0, 9))]
        symbols = "".join(turns.symbol(role[:1], faults[f]) for role, _, f in rows).encode()
        assert repairer.of_symbols(symbols) == searched(rows)[:2], rows


def test_runs_are_passed_by_powers():
    """Long runs: binary powers agree with single steps, and take few products."""
    r, repairer = random.Random(9), turns.Repairer()
    for _ in range(40):
        runs = [(r.choice("usaUA.-"), r.choice([1, 2, 3, 7, 40, 1000])) for _ in range(r.randint(1, 6))]
        cost, audit = repairer.repair(runs)
        single = turns.Repairer().repair([(s, 1) for s, n in runs for _ in range(n)])
        assert (cost, audit) == single
        assert len(audit) - audit.count("I") == sum(n for _, n in runs)
    one = turns.Repairer()
    one.repair([("u", 1_000_000)])
    assert len(one.costs) < 200 and len(one.powers) == 20


def test_odd_rows(spark):
    r = random.Random(5)
    rows = [(r.choice([1, 2, 3, 4, None]), r.choice([None, *range(12)]), r.choice(["user", "assistant", "system", None, "", "tool", "useful"]), r.choice([None, "", " \n", "Yes.", "no", "why? ", "Yes. ", "é!"])) for _ in range(120)]
    rows += [(9, t, "user", "long " * 20_000 + ".") for t in range(4)] + [(10, 5, "user", "Hi.")] * 7 + [(11, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(40)]
    rows += [(20 + i, t, "user", "a.") for i in range(40) for t in range(1)]  # some of them lose all rows
    want = plain(rows)
    assert any(w[7] == "" and w[1:7] == (0,) * 6 for w in want.values())
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"copies": F.lit(7), "digest": F.lit("clash"), "audit": F.lit("x"), "n": F.lit(0)})
    for parts in (1, 7):
        got = turns.repair_table(df.repartition(parts)).collect()
        assert {g.conv_id: tuple(g) for g in got} == want and len(got) == len(want)
    assert turns.repair_table(df.limit(0)).count() == 0


def test_repaired_rows_are_what_the_hash_is_of(spark):
    rows = turns.damaged(spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet"))
    fixed = turns.repair(rows, turns.audit(rows)).orderBy("conv_id", "turn").collect()
    texts: dict = {}
    for f in fixed:
        texts.setdefault(f.conv_id, []).append(f)
    hashes = {r.conv_id: r.repaired_sha256 for r in turns.repair_table(spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet")).collect()}
    for conv, sha in hashes.items():
        mine = texts.get(conv, [])
        assert GOAL.match("".join(m.role[0] for m in mine)) and [m.turn for m in mine] == list(range(len(mine)))
        assert hashlib.sha256("\n".join(f"{m.role}:{m.text}" for m in mine).encode()).hexdigest() == sha
