"""Ordered per-key fold with a tolerance band (change detection in sequence), split inside a key.

Some change rules are sequential: whether a row is a change depends on the
last *accepted* value for its key, not on the previous row.  That cannot be
written as a window expression.  It can be split, though: what a chunk of rows
does to an entry state is a function with few cases.  The first row it accepts
is one that sets a new maximum or minimum inside the chunk (or the first row, or
the first with a value), and from that row on everything follows from the
chunk's own values.  So the function of a chunk is the list of those rows, each
with the state at the chunk's end and the number of rows accepted on the way.

1. Rows are range-partitioned and sorted by key and order, so a key with a large
   share of the rows lies in many tasks.  In a task every key but the first
   starts there, with a known state: its events are found at once.  The rows of
   the first key may go on from the task before; they are kept, in chunks, and
   the chunks' functions are written.  This result is stored.
2. Per key the chunks' functions are applied one after the other (a row per
   chunk), which gives every chunk its entry state.
3. The kept chunks are replayed side by side from their entry states.

The next accepted row is found by vectorised search, so Python work grows with
the events, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.session import stage_table

EVENT_FIELDS = [
    T.StructField("old_value", T.DoubleType()),
    T.StructField("new_value", T.DoubleType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("_seq", T.IntegerType()),
]
#: Rows of a key whose function is made, and which are replayed, together.
CHUNK = 65_536
EVENT, KEPT, FUNCTION, EXIT = range(4)

_FUNCTION = [("_cmp", pa.list_(pa.float64())), ("_set", pa.list_(pa.bool_())), ("_end", pa.list_(pa.float64())), ("_n", pa.list_(pa.int64()))]
_WORK = [("_kind", pa.int32()), ("_part", pa.int32()), ("_chunk", pa.int32()), ("_pos", pa.int64()), ("_v", pa.float64()),
         ("_present", pa.bool_()), ("_state", pa.float64()), ("_before", pa.int32()),
         ("old_value", pa.float64()), ("new_value", pa.float64()), ("change_type", pa.string()), ("_seq", pa.int32()), *_FUNCTION]
_WORK_SQL = ("_kind int, _part int, _chunk int, _pos long, _v double, _present boolean, _state double, _before int, old_value double, "
             "new_value double, change_type string, _seq int, _cmp array<double>, _set array<boolean>, _end array<double>, _n array<long>")


@dataclass(frozen=True)
class Rule:
    """When a row replaces the state; no value is NaN."""
    tolerance: float
    null_state_blocks: bool
    null_value_as_zero: bool

    def compared(self, v: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(v), 0.0, v) if self.null_value_as_zero else v


@dataclass
class State:
    present: bool
    value: float
    seq: int = 0


class Rows:
    """Values of consecutive rows, with the search for accepted ones."""

    def __init__(self, rule: Rule, v: np.ndarray):
        self.rule, self.v, self.c = rule, v, rule.compared(v)
        # whether a row, once accepted, is followed by another accepted one
        self.steps = np.abs(v[:-1] - self.c[1:]) > rule.tolerance

    def first(self, present: bool, value: float, lo: int, hi: int) -> int:
        """The first of rows ``lo`` to ``hi`` accepted from a state, ``hi`` when none is."""
        if not present:
            return lo
        if value != value and self.rule.null_state_blocks:
            return hi
        size = 32
        while lo < hi:
            end = min(hi, lo + size)
            hit = ~np.isnan(self.v[lo:end]) if value != value else np.abs(self.c[lo:end] - value) > self.rule.tolerance
            k = int(hit.argmax())
            if hit[k]:
                return lo + k
            lo, size = end, size * 4
        return hi

    def next(self, i: int, hi: int) -> int:
        if i + 1 < hi and self.steps[i]:
            return i + 1
        return self.first(True, self.v[i], i + 1, hi)

    def accepted(self, state: State, lo: int, hi: int) -> list[int]:
        out = []
        i = self.first(state.present, state.value, lo, hi)
        while i < hi:
            out.append(i)
            i = self.next(i, hi)
        return out

    def function(self) -> dict[str, list]:
        """The rows that some entry state may accept first: what they are compared by, whether they set a value, state and count at the end."""
        n, c = len(self.v), self.c
        known = ~np.isnan(c)
        top = np.fmax.accumulate(np.where(known, c, -np.inf))
        low = np.fmin.accumulate(np.where(known, c, np.inf))
        first = np.ones(n, dtype=bool)
        first[1:] = known[1:] & ((c[1:] > top[:-1]) | (c[1:] < low[:-1]))
        valued = np.flatnonzero(~np.isnan(self.v))
        first[valued[:1]] = True
        after, end, count = {}, {}, {}
        for at in np.flatnonzero(first)[::-1].tolist():
            path, i = [], at
            while i < n and i not in end:
                path.append(i)
                after[i] = i = self.next(i, n)
            for i in reversed(path):
                end[i] = end[after[i]] if after[i] < n else float(self.v[i])
                count[i] = 1 + (count[after[i]] if after[i] < n else 0)
        at = np.flatnonzero(first)
        return {"_cmp": c[at].tolist(), "_set": (~np.isnan(self.v[at])).tolist(),
                "_end": [end[i] for i in at.tolist()], "_n": [count[i] for i in at.tolist()]}


def applied(rule: Rule, state: State, function: dict[str, list]) -> State:
    """The state after a chunk, from the state before and the chunk's function."""
    if not state.present:
        k = 0
    elif state.value != state.value:
        if rule.null_state_blocks or True not in function["_set"]:
            return state
        k = function["_set"].index(True)
    else:
        hit = np.abs(np.array(function["_cmp"], dtype=float) - state.value) > rule.tolerance
        k = int(hit.argmax())
        if not hit[k]:
            return state
    return State(True, function["_end"][k], state.seq + function["_n"][k])


def _number(x: float | None) -> float:
    return float("nan") if x is None else x


def _null(x: float) -> float | None:
    return None if x != x else x


def _starts(columns: list[pa.Array], before: list[pa.Array] | None) -> np.ndarray:
    """Whether each row's key differs from the row before; ``before`` is the last row of the batch before."""
    n = len(columns[0])
    same = np.ones(n, dtype=bool)
    for k, col in enumerate(columns):
        a, b = (col.slice(1), col.slice(0, n - 1)) if before is None else (col, pa.concat_arrays([before[k], col.slice(0, n - 1)]))
        equal = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        if pa.types.is_floating(col.type):
            equal = pc.or_(equal, pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False)))
        same[n - len(a):] &= equal.to_numpy(zero_copy_only=False)
    if before is None:
        same[:1] = False
    return ~same


@dataclass
class _Output:
    """Rows of one batch to write: taken rows of the input, with the columns of ``_WORK`` that they have."""
    batch: pa.RecordBatch
    passed: list[str]
    keys: list[str]
    parts: list[pa.RecordBatch] = field(default_factory=list)

    def add(self, rows: list[int] | np.ndarray, kind: int, whole: bool = True, **columns) -> None:
        n = len(rows)
        if not n:
            return
        taken = self.batch.take(pa.array(rows, pa.int64()))
        own = [taken.column(c) if whole or c in self.keys else pa.nulls(n, taken.column(c).type) for c in self.passed]
        columns["_kind"] = [kind] * n
        own += [pa.array(columns[c], t, from_pandas=True) if c in columns else pa.nulls(n, t) for c, t in _WORK]
        self.parts.append(pa.RecordBatch.from_arrays(own, names=[*self.passed, *[c for c, _ in _WORK]]))


def _events(rows: Rows, found: list[tuple[State, list[int]]]) -> dict[str, list]:
    """Event columns of accepted rows, and the states moved on."""
    out: dict[str, list] = {"old_value": [], "new_value": [], "change_type": [], "_seq": []}
    for state, accepted in found:
        for i in accepted:
            out["old_value"].append(_null(state.value) if state.present else None)
            out["new_value"].append(_null(float(rows.v[i])))
            out["change_type"].append("UPDATE" if state.present else "INSERT")
            state.present, state.value, state.seq = True, float(rows.v[i]), state.seq + 1
            out["_seq"].append(state.seq)
    return out


def deadband_fold(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: str,
                  tolerance: float, carry: Sequence[str] = (),
                  null_state_blocks: bool = False, null_value_as_zero: bool = False,
                  init_present: str | None = None, init_value: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """Emit INSERT / UPDATE events for ``rows`` processed per key in ``order_by`` order.

    Per key the state is the last accepted value (optionally seeded from the
    columns ``init_present`` / ``init_value``, the previous snapshot).
    A row is an INSERT when there is no state yet; otherwise an UPDATE when
    ``|state - value| > tolerance`` (a null value counts as 0 when
    ``null_value_as_zero``).  A null state never changes again when
    ``null_state_blocks``; otherwise a non-null value replaces it.  NaN is null.
    Rows of one key and order are taken by value, null first.
    Output: keys, order columns, carry columns, old_value, new_value,
    change_type, _seq (1-based event number within the key).
    """
    keys, order_by, carry = list(keys), list(order_by), list(carry)
    passed = list(dict.fromkeys(keys + order_by + carry))
    rule = Rule(float(tolerance), null_state_blocks, null_value_as_zero)
    present = F.coalesce(F.col(init_present).cast("boolean"), F.lit(False)) if init_present else F.lit(False)
    initial = F.col(init_value).cast("double") if init_present else F.lit(None).cast("double")
    prepared = rows.select(*[F.col(c) for c in passed], F.col(value).cast("double").alias("__fold_v"),
                           present.alias("__fold_p"), initial.alias("__fold_i"))
    order = [*keys, *[c for c in order_by if c not in keys], "__fold_v"]
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = prepared.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).withColumn("__fold_part", F.spark_partition_id())
    nullable = T.StructType([T.StructField(c, prepared.schema[c].dataType) for c in passed])
    work_schema = T.StructType(nullable.fields + T.StructType.fromDDL(_WORK_SQL).fields)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, state = None, State(False, float("nan"))
        entry: State | None = None    # of the leading key, which may go on from the task before
        leading, at = True, 0         # whether rows are still that key's, and how many it has so far
        held: list[np.ndarray] = []   # values of its open chunk
        last: _Output | None = None   # the batch before, still to be written

        def close(out: _Output, row: int, part: int) -> None:
            made = Rows(rule, np.concatenate(held)).function()
            held.clear()
            out.add([row], FUNCTION, whole=False, _part=[part], _chunk=[(at - 1) // chunk], _present=[entry.present],
                    _state=[_null(entry.value)], **{c: [x] for c, x in made.items()})

        part = 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            part = b.column(len(passed) + 3)[0].as_py()
            v, initial_v = (b.column(len(passed) + k).to_numpy(zero_copy_only=False).astype(float) for k in (0, 2))
            known = b.column(len(passed) + 1).to_numpy(zero_copy_only=False)
            columns = [b.column(passed.index(k)) for k in keys]
            starts = _starts(columns, before)
            before = [c.slice(n - 1) for c in columns]
            bounds = np.flatnonzero(starts).tolist()
            bounds = bounds if bounds[:1] == [0] else [0, *bounds]
            out, found, values = _Output(b, passed, keys), [], Rows(rule, v)
            for lo, hi in zip(bounds, [*bounds[1:], n]):
                if starts[lo]:
                    if entry is not None and leading:
                        leading = False
                        if held:
                            close(*((out, lo - 1) if lo else (last, last.batch.num_rows - 1)), part)
                    state = State(bool(known[lo]), float(initial_v[lo]))
                    entry = entry or state
                if not leading:
                    found.append((state, values.accepted(state, lo, hi)))
                    continue
                while lo < hi:
                    end = min(hi, lo + chunk - at % chunk)
                    out.add(np.arange(lo, end), KEPT, _part=[part] * (end - lo), _chunk=[at // chunk] * (end - lo),
                            _pos=np.arange(at, at + end - lo), _v=v[lo:end])
                    held.append(v[lo:end])
                    at += end - lo
                    if at % chunk == 0:
                        close(out, end - 1, part)
                    lo = end
            out.add(found_rows(found), EVENT, **_events(values, found))  # and moves the states on
            if last:
                yield from last.parts
            last = out
        if last:
            row = last.batch.num_rows - 1
            if not leading:
                last.add([row], EXIT, whole=False, _part=[part], _chunk=[-1], _present=[state.present],
                         _state=[_null(state.value)], _before=[state.seq])
            elif held:
                close(last, row, part)
            yield from last.parts

    def found_rows(found: list[tuple[State, list[int]]]) -> list[int]:
        return [i for _, accepted in found for i in accepted]

    work = stage_table(dealt.mapInArrow(first_pass, work_schema), "fold")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, state = None, None
        for b in batches:
            if not b.num_rows:
                continue
            columns = b.columns[:len(keys)]
            starts = _starts(columns, before)
            before = [c.slice(b.num_rows - 1) for c in columns]
            out = []
            for new, r in zip(starts.tolist(), b.select(b.schema.names[len(keys):]).to_pylist()):
                if r["_kind"] == EXIT:
                    state = State(r["_present"], _number(r["_state"]), r["_before"])
                    continue
                if new:
                    state = State(r["_present"], _number(r["_state"]))
                out.append((r["_part"], r["_chunk"], -1, state.present, _null(state.value), state.seq))
                state = applied(rule, state, {c: [_number(x) for x in r[c]] if c in ("_cmp", "_end") else r[c] for c, _ in _FUNCTION})
            if out:
                types = (pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.float64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[*at, "_pos", *entry_columns])

    at, entry_columns = ["_part", "_chunk"], ["_present", "_state", "_before"]
    functions = work.where(F.col("_kind") >= FUNCTION).select(*keys, "_kind", *at, *entry_columns, *[c for c, _ in _FUNCTION])
    entries = functions.repartition(*keys).sortWithinPartitions(*keys, *at).mapInArrow(
        chain, "_part int, _chunk int, _pos long, _present boolean, _state double, _before int")
    kept = work.where(F.col("_kind") == KEPT).select(*passed, *at, "_pos", "_v", *entry_columns)
    kept = kept.unionByName(entries, allowMissingColumns=True).repartition(*at).sortWithinPartitions(*at, "_pos")
    out_schema = T.StructType(nullable.fields + EVENT_FIELDS)
    names = out_schema.fieldNames()

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for b in batches:
            if not b.num_rows:
                continue
            col = {c: b.column(len(passed) + k) for k, c in enumerate([*at, "_pos", "_v", *entry_columns])}
            values, found = Rows(rule, col["_v"].to_numpy(zero_copy_only=False).astype(float)), []
            head = col["_pos"].to_numpy(zero_copy_only=False) < 0  # a chunk's entry state comes before its rows
            bounds = sorted({0, *np.flatnonzero(head).tolist()})
            for lo, hi in zip(bounds, [*bounds[1:], b.num_rows]):
                if head[lo]:
                    state = State(*(col[c][lo].as_py() for c in entry_columns))
                    state.value = _number(state.value)
                    lo += 1
                found.append((state, values.accepted(state, lo, hi)))
            rows = found_rows(found)
            events = _events(values, found)
            if rows:
                taken = b.select(passed).take(pa.array(rows, pa.int64()))
                types = (pa.float64(), pa.float64(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, *[pa.array(events[f.name], t) for f, t in zip(EVENT_FIELDS, types)]], names=names)

    direct = work.where(F.col("_kind") == EVENT).select(*names)
    return direct.unionByName(kept.mapInArrow(replay, out_schema))
