"""Conversation repair against an exhaustive search, a chart of all splits, and SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costindex.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, part string, chunk int, pos int, fault string, copy int"
WANTED = re.compile("(s?(ua)+)?")
INITIALS = ("s", "u", "a", "t")


def _exhaustive(rows, insertions=2):
    """Least (cost, audit) over all edits with at most ``insertions`` rows put into any gap."""
    gaps = [""] + ["".join(p) for n in range(1, insertions + 1) for p in itertools.product("ua", repeat=n)]
    options = []
    for initial, fault in rows:
        own = [(4, "D", "")]
        if fault not in ("blank", "duplicate"):
            more = 3 if fault == "truncated" else 0
            own += [(more, "K", initial), (3 + more, "R", "u"), (3 + more, "R", "a")]
        options += [[(3 * len(g), "I" * len(g), g) for g in gaps], own]
    options.append([(3 * len(g), "I" * len(g), g) for g in gaps])
    found = []
    for choice in itertools.product(*options):
        if WANTED.fullmatch("".join(c[2] for c in choice)):
            found.append((sum(c[0] for c in choice), "".join(c[1] for c in choice)))
    return min(found)


def _all_splits(cells):
    """The plain chart: every span from every pair of shorter ones."""
    n, table = len(cells), {}
    for size in range(1, n + 1):
        for i in range(n - size + 1):
            cell = dict(cells[i]) if size == 1 else {}
            for k in range(i + 1, i + size):
                for key, value in R.combine(table[i, k], table[k, i + size]).items():
                    cell[key] = min(cell.get(key, value), value)
            table[i, i + size] = cell
    return table[0, n]


def _rows(rng, n):
    return [(rng.choice(INITIALS), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(n)]


def test_cheapest_edits_against_exhaustive_search():
    rng = random.Random(2)
    for _ in range(60):
        rows = _rows(rng, rng.randint(1, 3))
        assert R.best(R.chart([R.cell_of(*r) for r in rows])[-1][0])[1:] == _exhaustive(rows)


def test_halved_spans_equal_all_splits_and_their_derivation():
    rng = random.Random(3)
    for _ in range(150):
        cells = [R.cell_of(*r) for r in _rows(rng, rng.randint(1, 14))]
        levels = R.chart(cells)
        assert levels[-1][0] == _all_splits(cells)
        q, cost, audit = R.best(levels[-1][0])
        steps = list(R.derivation(levels, R.START, q))
        assert len(steps) == len(cells) and steps[0][0] == R.START and steps[-1][1] == q
        assert [b for _, b in steps[:-1]] == [a for a, _ in steps[1:]]
        assert "".join(c[s][1] for c, s in zip(cells, steps)) == audit


def test_insertion_closure():
    assert R.CLOSURE[0, 3] == (6, "II") and R.CLOSURE[2, 3] == (3, "I") and (0, 1) not in R.CLOSURE


def _plain(rows):
    """Report and repaired text of one conversation of (turn, role, text) rows, by the plain chart."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        tail = text.rstrip(" \t\n\v\f\r")
        faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "" if tail[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = min(v for k, v in _all_splits([R.cell_of(r[1][:1], f) for r, f in zip(rows, faults)]).items() if k in ((0, 0), (0, 3)))
    turns = [t for t, _, _ in rows if t is not None]
    whole = "\n".join(f"{role}:{text}" for _, role, text in R.apply_edits([r[1:] for r in rows], audit, R.START))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return ((max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0), *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def _damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = (" " if r is None else r), (" " if x is None else x)
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
        out += [(c, t, "user" if d == 4 else r, x)] * {0: 0, 3: 2}.get(d, 1)
    return out


def _expected(rows):
    damaged = _damage(rows)
    out = []
    for c in {r[0] for r in rows}:
        own = [r[1:] for r in damaged if r[0] == c]
        out.append((c, *(_plain(own) if own else (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))))
    return sorted(out, key=str)


def _mixed(rng, n):
    texts = ["Yes.", "No!", "cut", "", " \t", None, "Why?\n", "word ", "x" * 70_000 + ".", "a\nb:c?"]
    roles = ["system", "user", "assistant", "tool", "", None, "sage", "<|im_end|>"]
    return [(rng.choice([None, 1, 2, 3, *range(10, 40)]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_report_equals_plain_version(spark, chunk):
    rows = _mixed(random.Random(chunk), 400)
    df = spark.createDataFrame([(*r, "p", 1, 2, "f", 3) for r in rows], SCHEMA)
    got = sorted([tuple(r) for r in R.repair_report(df, chunk).collect()], key=str)
    assert got == _expected(rows)


def test_one_long_conversation_lies_in_several_tasks(spark):
    rng = random.Random(9)
    rows = [(7, k // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["ok.", f"n {k}.", f"cut {k}", ""])) for k in range(4000)]
    df = spark.createDataFrame([(*r, "p", 1, 2, "f", 3) for r in rows], SCHEMA)
    placed = R.placed(R.with_faults(df), 64)
    parts = placed.groupBy("part").count().collect()
    assert len(parts) > 2 and placed.groupBy("part", "chunk").count().agg(F.max("count")).first()[0] <= 64
    report, repaired = R.repair(df, 64)
    got = report.collect()
    assert len(got) == 1
    audit = got[0].audit
    assert len(audit.replace("I", "")) == 4000
    cells = [R.cell_of(r.role[:1], r.fault) for r in placed.orderBy("part", "chunk", "pos").collect()]
    assert R.best(R.chart(cells)[-1][0])[1:] == (got[0].cost, audit)
    roles = [r.role[0] for r in repaired.orderBy("part", "chunk", "seq").collect()]
    assert WANTED.fullmatch("".join(roles))


def test_rows_repeated_very_often(spark):
    rows = [(1, 0, "user", "Hi.")] * 300 + [(1, 1, "assistant", "Yes.")]
    df = spark.createDataFrame([(*r, "p", 1, 2, "f", 3) for r in rows], SCHEMA)
    report, repaired = R.repair(df)
    r = report.first()
    assert (r.duplicate, r.cost, r.audit) == (299, 299 * 4, "K" + "D" * 299 + "K") and repaired.count() == 2


def test_empty_table(spark):
    got = R.repair_report(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[0] == "conv_id"


def test_given_conversations_equal_sql(spark):
    path = f"{SF_SMALL}/conversations.parquet"
    got = R.repair_report(spark.read.parquet(path))
    rows = duckdb.sql(R.REPAIR_SQL.replace("from conversations", f"from '{path}'")).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(rows)
