"""Repair of conversation structure by weighted CYK parsing.

A repaired conversation's roles, by their initials, are ``(s?(ua)+)?``: nothing, or
an optional system row and then pairs of user and assistant.  Every row is kept,
re-roled, or deleted, and rows without text may be inserted; the cheapest edits
win, of equally cheap ones those whose initials (the audit) are least in ASCII.

The grammar is in Chomsky normal form.  Its nonterminals are pairs (p, q) of states
of the automaton of the wanted form: what a span of rows becomes leads from p to
q.  A nonterminal is two shorter spans, ``(p, q) -> (p, r) (r, q)``, or one row with
its edit; empty spans derive insertions, whose closure is taken once and put
around every row.  A cell of the chart holds, for every nonterminal, the least
(cost, audit) over its span.  Spans are combined bottom-up by length 1, 2, 4, ...:
as every derivation of a span can be cut between any two of its rows, one way to
halve a span is enough.  Comparing audits of equal cost is sound: neither can
begin the other, as what follows would be insertions, which cost.

Rows are put in order by a range partitioning of (conversation, turn, role, text),
so a conversation with very many rows lies in several tasks.  Its rows are parsed in
chunks of at most ``CHUNK``; the chunks' cells are combined like any other spans.

Defined results: rows are ordered by turn (null first), then role and text; a null
role or text counts as one space; rows without a conversation id are one
conversation; equal rows of one turn are repeated rows, all but the first of them
duplicates; a role's initial is its first character, and rows whose initial is no
s, u or a (or whose role is empty) cannot be kept as they are; a very long text is
handled whole, but not carried into the chart; an empty table gives empty ones.
A conversation's audit, a character an edit, is one value of one row.  Only the
four columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import ASCII_SPACE, partitions, stage
from costindex.operators.keys import null_safe_join

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: Further cost of a truncated row that is not deleted.
TRUNCATED_COST = 3
#: Rows of a conversation parsed together.
CHUNK = 512

# The automaton: 0 nothing yet, 1 after the system row, 2 after a user, 3 after an assistant.
START, ACCEPTED = 0, (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = range(4)
SAID = {"u": "user", "a": "assistant"}
#: The row that an insertion or a new role gives in each state.
NEXT = {p: role for (p, role) in STEPS if role in SAID}

Cell = dict[tuple[int, int], tuple[int, str]]


def _better(cell: Cell, key: tuple[int, int], value: tuple[int, str]) -> bool:
    if key not in cell or value < cell[key]:
        cell[key] = value
        return True
    return False


def _insertions() -> Cell:
    """Cells of the empty span: the cheapest insertions between any two states."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    grown = True
    while grown:
        grown = False
        for (p, q), (cost, audit) in list(cell.items()):
            if q in NEXT:
                grown |= _better(cell, (p, STEPS[q, NEXT[q]]), (cost + COST[INSERT], audit + INSERT))
    return cell


CLOSURE = _insertions()


def _derivable() -> set[tuple[int, int]]:
    """Pairs of states that the edits of some span lead between."""
    pairs = set(CLOSURE) | {(p, q) for (p, _), q in STEPS.items()}
    while more := {(p, b) for p, q in pairs for a, b in pairs if a == q} - pairs:
        pairs |= more
    return pairs


#: Nonterminals, and the binary rules (p, q) -> (p, r) (r, q) as triples (p, r, q).
PAIRS = sorted(_derivable())
RULES = [(p, r, q) for p, r in PAIRS for a, q in PAIRS if a == r]


def combine(left: Cell, right: Cell) -> Cell:
    """The cells of two neighbouring spans as those of their union."""
    out: Cell = {}
    for p, r, q in RULES:
        a, b = left.get((p, r)), right.get((r, q))
        if a is not None and b is not None:
            _better(out, (p, q), (a[0] + b[0], a[1] + b[1]))
    return out


def row_cell(initial: str, fault: str) -> Cell:
    """The cells of one row: its edits, with insertions around."""
    cell: Cell = {(p, p): (COST[DELETE], DELETE) for p in STATES}
    if fault not in ("blank", "duplicate"):
        more = TRUNCATED_COST if fault == "truncated" else 0
        for (p, role), q in STEPS.items():
            if role == initial:
                _better(cell, (p, q), (COST[KEEP] + more, KEEP))
            if role in SAID:
                _better(cell, (p, q), (COST[REROLE] + more, REROLE))
    return combine(combine(CLOSURE, cell), CLOSURE)


_ROW_CELLS: dict[tuple[str, str], Cell] = {}


def cell_of(initial: str, fault: str) -> Cell:
    key = (initial if initial in ("s", "u", "a") else "", fault)
    if key not in _ROW_CELLS:
        _ROW_CELLS[key] = row_cell(*key)
    return _ROW_CELLS[key]


def chart(cells: list[Cell]) -> list[list[Cell]]:
    """Cells by span length: level k has the spans of 2**k neighbouring ones (the last may be shorter)."""
    levels = [cells]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([combine(*below[i:i + 2]) if i + 1 < len(below) else below[i] for i in range(0, len(below), 2)])
    return levels


def best(cell: Cell) -> tuple[int, int, str]:
    """(end state, cost, audit) of the cheapest accepted derivation."""
    q = min((q for q in ACCEPTED if (START, q) in cell), key=lambda q: cell[START, q])
    return (q, *cell[START, q])


def derivation(levels: list[list[Cell]], p: int, q: int) -> Iterator[tuple[int, int]]:
    """(entry, end) state of every leaf in the derivation of (p, q) over the whole span."""
    def down(level: int, i: int, p: int, q: int) -> Iterator[tuple[int, int]]:
        if level == 0:
            yield p, q
            return
        halves = levels[level - 1][2 * i:2 * i + 2]
        if len(halves) == 1:
            yield from down(level - 1, 2 * i, p, q)
            return
        left, right = halves
        r = min((r for a, r, b in RULES if (a, b) == (p, q) and (p, r) in left and (r, q) in right),
                key=lambda r: (left[p, r][0] + right[r, q][0], left[p, r][1] + right[r, q][1]))
        yield from down(level - 1, 2 * i, p, r)
        yield from down(level - 1, 2 * i + 1, r, q)

    yield from down(len(levels) - 1, 0, p, q)


def apply_edits(rows: Iterable[tuple[str, str]], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what the edits of ``audit`` leave of (role, text) rows, from ``state`` on."""
    rows = iter(rows)
    for edit in audit:
        if edit == INSERT:
            said, text = SAID[NEXT[state]], ""
        else:
            said, text = next(rows)
            if edit == DELETE:
                continue
            if edit == REROLE:
                said = SAID[NEXT[state]]
        state = STEPS[state, said[0]]
        yield edit, said, text


# ---- on Spark -----------------------------------------------------------------------

CELLS = "array<struct<p:int,q:int,cost:long,audit:string>>"
#: Of a chunk, on its last row.
SUMMARY = (f"struct<n:long,blank:long,duplicate:long,truncated:long,illegal:long,first:string,last:string,"
           f"turns:long,first_turn:long,last_turn:long,cells:{CELLS}>")
LEGAL = ("su", "ua", "au")


def with_faults(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """conv_id, turn, role, text, copy, fault: every row with its first fault (blank, duplicate, truncated, or empty).

    Equal rows of a turn are counted before they are dealt out again as
    copies, and the first turn of a (role, text) is a partial aggregate, so
    rows repeated very often stay spread.
    """
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    kinds = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    kinds = stage(kinds.withColumn("said", F.sha2("text", 256)), "repair-rows")
    seen = kinds.groupBy("conv_id", "role", "said").agg(F.min(F.struct("turn")).alias("first"))
    kinds = null_safe_join(kinds, seen, ["conv_id", "role", "said"])
    tail = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    later = (F.col("copy") > 1) | ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return kinds.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "conv_id", "turn", "role", "text", "copy",
        F.when(tail == "", "blank").when(later, "duplicate")
        .when(~F.right(tail, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("").alias("fault"))


class _Chunk:
    """What is known of the rows of one chunk."""

    def __init__(self):
        self.cells: list[Cell] = []
        self.initials: list[str] = []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.turns: list[int | None] = []

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self.cells.append(cell_of(initial, fault))
        self.initials.append(initial)
        self.faults[fault] += 1
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def summary(self) -> dict:
        top = chart(self.cells)[-1][0]
        illegal = sum(a + b not in LEGAL for a, b in zip(self.initials, self.initials[1:]))
        return {"n": len(self.cells), **{k: v for k, v in self.faults.items() if k}, "illegal": illegal,
                "first": self.initials[0], "last": self.initials[-1], "turns": len(self.turns),
                "first_turn": self.turns[0] if self.turns else None, "last_turn": self.turns[-1] if self.turns else None,
                "cells": [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in top.items()]}


_CELLS = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SUMMARY = pa.struct([(n, pa.int64()) for n in ("n", "blank", "duplicate", "truncated", "illegal")]
                     + [(n, pa.string()) for n in ("first", "last")]
                     + [(n, pa.int64()) for n in ("turns", "first_turn", "last_turn")] + [("cells", _CELLS)])


def placed(faults: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows in order, with the place (part, chunk, pos) of each; the last row of a chunk carries its summary.

    The result is a stored table, as other partitionings would give other places.
    """
    order = ["conv_id", "turn", "role", "text", "copy"]
    dealt = faults.repartitionByRange(partitions(faults.sparkSession), *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.spark_partition_id())
    schema = dealt.select("*", F.lit(0).alias("chunk"), F.lit(0).alias("pos"), F.lit(None).cast(SUMMARY).alias("summary")).schema
    at = {n: dealt.columns.index(n) for n in ("conv_id", "turn", "role", "fault")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number, pos, told = None, 0, 0, None  # the open chunk and its conversation

        def done(b: pa.RecordBatch, numbers: list, places: list, told_at: dict) -> pa.RecordBatch:
            summaries = [told_at.get(i) for i in range(b.num_rows)]
            return pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(numbers, pa.int32()), pa.array(places, pa.int32()), pa.array(summaries, _SUMMARY)],
                names=[*b.schema.names, "chunk", "pos", "summary"])

        held = None  # the batch before, whose last row may end a chunk
        for b in batches:
            if b.num_rows == 0:
                continue
            numbers, places, told_at = [], [], {}
            columns = [b.column(at[n]).to_pylist() for n in ("conv_id", "turn", "role", "fault")]
            for i, (conv, turn, role, fault) in enumerate(zip(*columns)):
                if now is not None and (conv != told or pos == chunk):
                    if i:
                        told_at[i - 1] = now.summary()
                    else:
                        held[3][held[0].num_rows - 1] = now.summary()
                    now = None
                if now is None:
                    now, number, pos, told = _Chunk(), number + 1, 0, conv
                now.add(turn, role[:1], fault)
                numbers.append(number)
                places.append(pos)
                pos += 1
            if held:
                yield done(*held)
            held = (b, numbers, places, told_at)
        if held:
            held[3][held[0].num_rows - 1] = now.summary()
            yield done(*held)

    return stage(dealt.mapInArrow(run, schema), "repair-placed")


def _totals(chunks: list[dict]) -> dict:
    """The report of a conversation from its chunks' summaries, in order."""
    report = {k: sum(c[k] for c in chunks) for k in ("blank", "duplicate", "truncated", "illegal")}
    report["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(chunks, chunks[1:]))
    dated = [c for c in chunks if c["turns"]]
    turns = sum(c["turns"] for c in dated) - sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
    report["gaps"] = dated[-1]["last_turn"] - dated[0]["first_turn"] + 1 - turns if dated else 0
    return report


def decided(rows: DataFrame) -> DataFrame:
    """From ``placed`` rows, one row per chunk: conv_id, part, chunk, entry state, audit, and on the first chunk the report.

    The summaries of a conversation, one for every ``CHUNK`` rows, are combined in one task.
    """
    keys = ["conv_id", "part", "chunk"]
    told = rows.filter(F.col("summary").isNotNull()).select(*keys, "summary")
    told = told.repartition("conv_id").sortWithinPartitions(*keys)
    report = F.lit(None).cast("struct<gaps:long,blank:long,duplicate:long,truncated:long,illegal:long,cost:long,audit:string>")
    schema = told.select(*keys, F.lit(0).alias("entry"), F.lit("").alias("audit"), report.alias("report")).schema
    arrow = pa.struct([(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])

    def decide(conv, chunks: list[tuple]) -> list[tuple]:
        summaries = [s for _, _, s in chunks]
        levels = chart([{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in summaries])
        q, cost, audit = best(levels[-1][0])
        out = []
        for (part, number, _), (p, r), cell in zip(chunks, derivation(levels, START, q), levels[0]):
            out.append((conv, part, number, p, cell[p, r][1], None))
        out[0] = (*out[0][:5], _totals(summaries) | {"cost": cost, "audit": audit})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, chunks = None, []

        def made(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            types = (kind, pa.int32(), pa.int32(), pa.int32(), pa.string(), arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                              names=[*keys, "entry", "audit", "report"])

        for b in batches:
            out = []
            for c, part, number, s in zip(*[x.to_pylist() for x in b.columns]):
                if chunks and c != conv:
                    out += decide(conv, chunks)
                    chunks = []
                conv = c
                chunks.append((part, number, s))
            if out:
                yield made(out, b.schema.types[0])
            kind = b.schema.types[0]
        if chunks:
            yield made(decide(conv, chunks), kind)

    return stage(told.mapInArrow(run, schema), "repair-decided")


def _streamed(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows and decisions in one frame, to be sorted so that a chunk's decision comes before its rows."""
    cols = ["conv_id", "part", "chunk"]
    a = decisions.select(*cols, F.lit(-1).alias("pos"), "entry", "audit", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    b = rows.select(*cols, "pos", F.lit(None).cast("int").alias("entry"), F.lit(None).cast("string").alias("audit"), "role", "text")
    return a.unionByName(b)


def repaired_rows(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, part, chunk, seq (their order), edit, role, text.

    Rows are dealt by chunk, so a conversation with very many rows stays spread.
    """
    keys = ["conv_id", "part", "chunk"]
    d = _streamed(rows, decisions).repartition(*keys).sortWithinPartitions(*keys, "pos")
    schema = d.select(*keys, F.lit(0).alias("seq"), F.lit("").alias("edit"), "role", "text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, entry, audit, chunk = None, 0, "", []

        def made() -> list[tuple]:
            return [(*key, i, *x) for i, x in enumerate(apply_edits(chunk, audit, entry))]

        def out(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            types = (kind, pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        for b in batches:
            ready, kind = [], b.schema.types[0]
            for c, part, number, pos, e, a, role, text in zip(*[x.to_pylist() for x in b.columns]):
                if pos < 0:
                    if key is not None:
                        ready += made()
                    key, entry, audit, chunk = (c, part, number), e, a, []
                else:
                    chunk.append((role, text))
            if ready:
                yield out(ready, kind)
        if key is not None and (ready := made()):
            yield out(ready, kind)

    return d.mapInArrow(run, schema)


def repair(conversations: DataFrame, chunk: int = CHUNK, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(report, repaired rows) of all conversations that have rows.

    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    """
    rows = placed(with_faults(conversations, **columns), chunk)
    decisions = decided(rows)
    report = decisions.filter(F.col("report").isNotNull()).select("conv_id", "report.*")
    return report, repaired_rows(rows, decisions)


# ---- the registered query -------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of the contract's input, damaged by the crc32 of ``conv_id:turn`` (nulls: one space)."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"),
                             F.pmod(F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))), F.lit(20)).alias("damage"))
    damage = F.col("damage")
    d = d.filter(damage != 0).withColumns({
        "text": F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(damage == 4, "user").otherwise(F.col("role"))})
    return d.withColumn("again", F.explode(F.sequence(F.lit(1), F.when(damage == 3, 2).otherwise(1)))).drop("damage", "again")


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of ``role:text`` joined by newlines, each conversation streamed through the hash in order."""
    d = repaired.select("conv_id", "part", "chunk", "seq", "role", "text").repartition("conv_id")
    d = d.sortWithinPartitions("conv_id", "part", "chunk", "seq").select("conv_id", "role", "text")
    schema = d.select("conv_id", F.lit("").alias("repaired_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None

        def out(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (kind, pa.string()))], names=schema.names)

        for b in batches:
            ready, kind = [], b.schema.types[0]
            for c, role, text in zip(*[x.to_pylist() for x in b.columns]):
                if digest is not None and c != conv:
                    ready.append((conv, digest.hexdigest()))
                    digest = None
                if digest is None:
                    conv, digest = c, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if ready:
                yield out(ready, kind)
        if digest is not None:
            yield out([(conv, digest.hexdigest())], kind)

    return d.mapInArrow(run, schema)


def repair_report(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The contract's report of every conversation of ``conversations``, after its damage."""
    report, repaired = repair(damaged(conversations), chunk)
    d = null_safe_join(conversations.select("conv_id").distinct(), report, ["conv_id"], "left")
    d = null_safe_join(d, repaired_digests(repaired), ["conv_id"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return d.select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _added(cell: str, cost: str, edit: str) -> str:
    return f"(lpad((left({cell}, 12)::bigint + {cost})::varchar, 12, '0') || substr({cell}, 13) || '{edit}')"


def _sql() -> str:
    """DuckDB SQL of the report: the edits by a left-to-right recursion over rows, a cell being cost and audit in one text."""
    crc = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(range(1, length(k) + 1),
      lambda i: [ascii(substr(k, i, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end), 4294967295::bigint)"""
    kept, more = "fault not in ('blank', 'duplicate')", "more"
    to_user = "least(c0, c1, c3)"
    rerole = lambda cell: f"case when {kept} then {_added(cell, f'3 + {more}', 'R')} end"
    keep = lambda role, cell: f"case when {kept} and initial = '{role}' then {_added(cell, more, 'K')} end"
    drop = lambda p: _added(f"c{p}", "4", "D")
    said = "case when letter = 'K' then role when state = 2 then 'assistant' else 'user' end"
    return f"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
damage as (select *, {crc} % 20 as d from keyed),
damaged as (
  select conv_id, turn, if(d = 4, 'user', role) as role,
    case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from damage, (values (1), (2)) again(time) where d <> 0 and (d = 3 or time = 1)),
convs as (select conv_id, row_number() over (order by conv_id nulls first) as g from (select distinct conv_id from conversations)),
numbered as (
  select g, turn, role, text, left(role, 1) as initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as tail,
    row_number() over (partition by g order by turn nulls first, role, text) as rn
  from damaged join convs on convs.conv_id is not distinct from damaged.conv_id),
rows as (
  select *, case when tail = '' then 'blank' when row_number() over (partition by g, role, text order by rn) > 1 then 'duplicate'
    when right(tail, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
    lag(initial) over (partition by g order by rn) || initial as pair
  from numbered),
counts as (
  select g, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from rows group by g),
walk(g, rn, c0, c1, c2, c3) as (
  select g, 0::bigint, '000000000000', null::varchar, '000000000003I', '000000000006II' from counts
  union all
  select g, rn, d0, d1, e2, least(d3, {_added("e2", "3", "I")})
  from (
    select *, least(d2, {_added("d0", "3", "I")}, {_added("d1", "3", "I")}, {_added("d3", "3", "I")}) as e2
    from (
      select w.g, r.rn, {drop(0)} as d0, least({drop(1)}, {keep("s", "c0")}) as d1,
        least({drop(2)}, {keep("u", to_user)}, {rerole(to_user)}) as d2,
        least({drop(3)}, {keep("a", "c2")}, {rerole("c2")}) as d3
      from walk w join (select *, if(fault = 'truncated', 3, 0) as more from rows) r on r.g = w.g and r.rn = w.rn + 1) x) y),
ends as (select g, n, least(c0, c3) as cell from walk join counts using (g) where rn = n),
audits as (select g, left(cell, 12)::bigint as cost, substr(cell, 13) as audit from ends),
said(g, spot, rn, state, whole, audit) as (
  select g, 0::bigint, 0::bigint, 0, null::varchar, audit from audits
  union all
  select g, spot, rn, case when letter = 'D' then state when {said}[1:1] = 's' then 1 when {said}[1:1] = 'u' then 2 else 3 end,
    case when letter = 'D' then whole else coalesce(whole || chr(10), '') || {said} || ':' || if(letter = 'I', '', text) end, audit
  from (
    select s.g, s.spot + 1 as spot, substr(s.audit, s.spot + 1, 1) as letter, s.rn + if(letter = 'I', 0, 1) as rn, s.state, s.whole, s.audit,
      r.role, r.text
    from said s left join rows r on r.g = s.g and r.rn = s.rn + 1 where s.spot < length(s.audit)) z),
texts as (select g, whole from said where spot = length(audit))
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
  coalesce(audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from convs left join counts using (g) left join audits using (g) left join texts using (g)"""


REPAIR_SQL = _sql()
