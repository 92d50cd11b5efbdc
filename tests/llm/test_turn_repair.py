import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from zonecast.llm import turn_repair as tr

FORM = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def least(rows):
    """(cost, audit, roles) by trying every edit of (initial, fault) rows."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    options = [["D"] if f in (1, 2) else ["D", "K", "u", "a"] for _, f in rows]
    for edits in itertools.product(*options):
        for ins in itertools.product(gaps, repeat=len(rows) + 1):
            form = audit = ins[0]
            audit, cost = "I" * len(ins[0]), 5 * len(ins[0])
            for (initial, fault), e, gap in zip(rows, edits, ins[1:]):
                form += {"D": "", "K": initial}.get(e, e) + gap
                audit += ("R" if e in "ua" else e) + "I" * len(gap)
                cost += {"D": 2, "K": 0}.get(e, 1) + 5 * len(gap) + (5 if fault == 3 and e != "D" else 0)
            if FORM.fullmatch(form) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def chart(rows):
    """The plain cubic parser: every split of every span."""
    n = len(rows)
    cell = {(i, i + 1): tr.row_cell(*rows[i]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            best = {}
            for k in range(i + 1, i + length):
                for pq, found in tr.combine(cell[i, k], cell[k, i + length]).items():
                    best[pq] = min(found, best.get(pq, found))
            cell[i, i + length] = best
    return cell[0, n]


def forward(rows):
    """Shortest path row by row, an independent form of the same search."""
    def insert(best):
        for _ in range(2):
            for p, (c, a) in list(best.items()):
                q = tr.STEP[p, tr.NEXT_ROLE[p][0]]
                best[q] = min((c + 5, a + "I"), best.get(q, (c + 5, a + "I")))
        return best
    best = insert({0: (0, "")})
    for initial, fault in rows:
        new = {}
        for p, (c, a) in best.items():
            ways = [(p, c + 2, "D")]
            if fault in (0, 3):
                stay = 5 * (fault == 3)
                ways += [(tr.STEP[p, x], c + 1 + stay, "R") for x in "ua" if (p, x) in tr.STEP]
                ways += [(tr.STEP[p, initial], c + stay, "K")] if (p, initial) in tr.STEP else []
            for q, cost, e in ways:
                new[q] = min((cost, a + e), new.get(q, (cost, a + e)))
        best = insert(new)
    return min(best[q] for q in (0, 3) if q in best)


def random_rows(r, n):
    return [(r.choice("suuaaax"), r.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n)]


def answer(cell):
    return min(cell[0, q] for q in tr.ACCEPTING if (0, q) in cell)


@pytest.mark.parametrize("n", range(4))
def test_cheapest_edits_equal_trying_all(n):
    r = random.Random(n)
    for _ in range(2 if n == 3 else 30):
        rows = random_rows(r, n)
        assert answer(tr.parse(rows)) == least(rows)


def test_every_split_gives_the_same_cell():
    r = random.Random(7)
    for n in range(1, 14):
        for _ in range(4):
            rows = random_rows(r, n)
            assert tr.parse(rows) == chart(rows)
            assert answer(tr.parse(rows)) == forward(rows)
    rows = random_rows(r, 3000)
    assert answer(tr.parse(rows)) == forward(rows)


def brute(table):
    """Every report row of the damage and repair, from plain Python."""
    groups = collections.defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        code = zlib.crc32(":".join(shown).encode()) % 20
        groups[conv]
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            groups[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = {t for t, _, _ in rows if t is not None}
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [x[1][:1] for x in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = forward(list(zip(initials, faults)))
        lines, state, at = [], 0, iter(rows)
        for e in audit:
            _, role, text = (None, "", "") if e == "I" else next(at)
            if e == "D":
                continue
            role = role if e == "K" else tr.NEXT_ROLE[state]
            state = tr.STEP[state, role[:1]]
            lines.append((e, role, text))
        text = "\n".join(f"{a}:{b}" for _, a, b in lines)
        out.append(((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(1), faults.count(2),
                     faults.count(3), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), lines))
    return out


@pytest.fixture(scope="module")
def table():
    r = random.Random(11)
    rows = [(c, t, r.choice(["system", "user", "assistant", "user", "assistant", "tool", None]),
             r.choice(["Hi.", "Yes! ", "cut off", "", " \n", None, f"text {r.random()}?", "é。", "long. " * 50 + "\t"]))
            for c in range(300) for t in range(r.randrange(1, 12))]
    rows += [(1000, None, "user", "no turn."), (1000, None, "user", "no turn."), (1000, None, "assistant", None),
             (1000, 5, "system", "late."), (None, 0, "user", "a."), (None, 1, "assistant", "b."), (None, None, None, None),
             (1001, 3, "user", "Same."), (1001, 3, "user", "Same."), (1001, 3, "assistant", "Same."), (1002, 7, "unit", "x."),
             (1003, -4, "", "x."), (1003, 10**12, "assistant", "y" * 500_000 + ".")]
    rows += [(2000, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(5000)]
    return rows


def found(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_reports_equal_brute_force(spark, table, monkeypatch):
    data = spark.createDataFrame(table, SCHEMA)
    for name in ("dropped", "fault", "again", "code", "copy", "audit"):
        data = data.withColumn(name, F.lit(1))
    want = brute(table)
    rows = tr.damaged(data)
    report = tr.repair(rows)
    assert found(report) == collections.Counter(x for x, _ in want)
    assert found(tr.repair(tr.damaged(data.repartition(37)))) == collections.Counter(x for x, _ in want)
    turns = tr.repaired_turns(rows, report).collect()
    got = collections.defaultdict(list)
    for t in sorted(turns, key=lambda t: t.position):
        got[t.conv_id].append((t.edit, t.role, t.text))
    assert dict(got) == {x[0]: lines for x, lines in want if lines}


def test_all_dropped_and_empty(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = tr.repair(tr.damaged(spark.createDataFrame([(lost, 0, "user", "x.")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert tr.repair(tr.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_whole_table_equals_brute_force(spark):
    from zonecast.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_conversation_repair"](spark, sf)) == collections.Counter(x for x, _ in brute(data))
