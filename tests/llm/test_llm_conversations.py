"""Conversation repair against exhaustive edits and a plain pass over the rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from editflow.llm import conversation_repair as cr
from editflow.llm import queries

SPACE = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?")
NAME = {"u": "user", "a": "assistant"}


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        last = text.rstrip(SPACE)[-1:]
        out.append(1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0)
        seen.add((role, text))
    return out


def exhaustive(rows):
    """All edits of at most four rows with at most one insertion (two cost more than deleting all)."""
    found = []
    for edits in itertools.product("KuaD", repeat=len(rows)):
        marks = [(e, i) for i, e in enumerate(edits)]
        cost = sum({"K": 0, "u": 1, "a": 1, "D": 2}[e] for e in edits)
        fault = faults(rows)
        if any(e != "D" and fault[i] in (1, 2) for e, i in marks):
            continue
        cost += sum(5 for e, i in marks if e != "D" and fault[i] == 3)
        options = [marks] + [marks[:k] + [(x, None)] + marks[k:] for k in range(len(marks) + 1) for x in "UA"]
        for seq in options:
            roles = [rows[i][0][:1] if e == "K" else e.lower() for e, i in seq if e != "D"]
            if GOOD.fullmatch("".join(roles)) and all(len(r) == 1 for r in roles):
                audit = "".join({"u": "R", "a": "R", "U": "I", "A": "I"}.get(e, e) for e, _ in seq)
                found.append((cost + 5 * (len(seq) > len(marks)), audit))
    return min(found)


def plain(rows):
    """Left to right over rows, least (cost, audit) at each place of the pattern."""
    nexts = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def inserted(best):
        for _ in range(4):
            for (p, x), q in nexts.items():
                if p in best and x in NAME:
                    value = (best[p][0] + 5, best[p][1] + "I")
                    best[q] = min(best.get(q, value), value)
        return best

    best = inserted({"": (0, "")})
    for (role, _), fault in zip(rows, faults(rows), strict=True):
        new = {p: (c + 2, a + "D") for p, (c, a) in best.items()}
        for (p, x), q in nexts.items():
            if p in best and fault not in (1, 2):
                cost, audit = best[p]
                for edit, ok, price in (("K", role[:1] == x, 0), ("R", x in NAME, 1)):
                    if ok:
                        value = (cost + price + 5 * (fault == 3), audit + edit)
                        new[q] = min(new.get(q, value), value)
        best = inserted(new)
    return min(best[p] for p in ("", "a") if p in best)


def rebuilt(rows, audit):
    total = sum(e != "D" for e in audit)
    left, out = iter(rows), []
    for edit in audit:
        role, text = next(left) if edit != "I" else ("", "")
        if edit != "D":
            due = "user" if (len(out) - total % 2) % 2 == 0 else "assistant"
            out.append((role if edit == "K" else due, text))
    return out


def damaged(conv, turn, role, text):
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    h = zlib.crc32(key.encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
    return [(turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)


def expected(table):
    out = {}
    for conv in {r[0] for r in table}:
        rows = [d for r in table if r[0] == conv for d in damaged(*r)]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        said = [(role, text) for _, role, text in rows]
        turns = [t for t, _, _ in rows if t is not None]
        fault = faults(said)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit = plain(said)
        lines = "\n".join(f"{r}:{t}" for r, t in rebuilt(said, audit))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(fault.count(k) for k in (1, 2, 3)), illegal, cost, audit,
                     hashlib.sha256(lines.encode()).hexdigest())
    return out


def _table(seed=1, convs=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "And?", "well", "", " \t", None, "a. b", "é.\n", "Long. " * 30, "x\u0085", "end. "]
    roles = ["user", "user", "assistant", "assistant", "system", None, "", "tool", "User"]
    rows = []
    for c in range(convs):
        conv = None if c == 7 else c
        rows += [(conv, None if rng.random() < 0.05 else t + rng.randrange(2), rng.choice(roles), rng.choice(texts) if rng.random() < .5
                  else f"text {rng.random()}.") for t in range(rng.randrange(1, 9))]
    rows += [(1000, t, ["user", "assistant"][t % 2], f"turn {t % 400}" + "." * (t % 5 > 0)) for t in range(1500)]
    rows += [(1001, 3, "user", "same.")] * 600 + [(1002, None, None, None)] * 3
    return rows


def test_cells_are_the_cheapest_edits():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice(["user", "assistant", "system", "", "tool"]), rng.choice(["a.", "b!", "c", " ", "d?"]))
                for _ in range(rng.randrange(0, 5))]
        leaves = [cr.leaf(role[:1], fault) for (role, _), fault in zip(rows, faults(rows), strict=True)]
        assert cr.best(cr.chart(leaves)) == exhaustive(rows) == plain(rows), rows


def test_split_of_a_span_does_not_matter():
    rng = random.Random(6)
    for _ in range(100):
        leaves = [cr.leaf(rng.choice("suax"), rng.randrange(4)) for _ in range(7)]
        whole = cr.chart(leaves)
        for k in range(1, 7):
            assert cr.combine(cr.chart(leaves[:k]), cr.chart(leaves[k:])) == whole


@pytest.mark.parametrize("bits,fan", [(9, 64), (3, 2)])
def test_query(spark, tmp_path, monkeypatch, bits, fan):
    monkeypatch.setattr(cr, "SEGMENT_BITS", bits)
    monkeypatch.setattr(cr, "FAN", fan)
    table = _table()
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    for extra in ("conv", "seg", "pos", "fault", "audit", "k"):
        df = df.withColumn(extra, F.lit("extra"))
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_interval_repair(spark, str(tmp_path)).collect()}
    want = expected(table)
    assert got.keys() == want.keys()
    for conv, row in want.items():
        assert got[conv] == row, conv


def test_repaired_rows_and_empty(spark):
    rows = [("c", 0, "user", "Hi."), ("c", 1, "user", "Bye."), ("d", 0, "assistant", "half"), ("e", 5, "system", "S.")]
    df = spark.createDataFrame(rows, "conv string, turn int, who string, said string")
    repair = cr.Repair(df, "conv", "turn", "who", "said")
    got = [tuple(r) for r in repair.repaired().orderBy("conv", "place").collect()]
    assert got == [("c", 0, "user", "Hi.", "K"), ("c", 1, "assistant", "Bye.", "R")]
    assert {r["conv"]: r["audit"] for r in repair.report().collect()} == {"c": "KR", "d": "D", "e": "D"}
    none = cr.Repair(df.limit(0), "conv", "turn", "who", "said")
    assert none.report().count() == none.repaired().count() == none.digests().count() == 0
