"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from costindex.session import stage_table

#: White space that separates words: space and \t \n \v \f \r (fixed by the query contracts).
ASCII_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

#: Elements whose running fold is taken directly (see ``running``).
ARRAY_BLOCK = 64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    return stage_table(df, f"llm-{name}")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name`` or, when the table already has it (in any case), a variant that it does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def append_columns(df: DataFrame, text_col: str, fields: list[tuple[str, pa.DataType, str]],
                   kernel: Callable[[list[str]], list[Iterable]]) -> DataFrame:
    """Add columns computed from the whole text of each row, an Arrow batch at a time.

    ``kernel`` gets the texts of a batch (null: empty) and returns one sequence
    per field ``(name, arrow type, spark type)``.  Other columns pass through.
    """
    schema = df.select("*", *[F.lit(None).cast(t).alias(n) for n, _, t in fields]).schema
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            texts = [t or "" for t in b.column(at).to_pylist()]
            new = [pa.array(v, type=t) for v, (_, t, _) in zip(kernel(texts), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], names=[*b.schema.names, *[n for n, _, _ in fields]])

    return df.mapInArrow(run, schema)


def unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union the pairs ``(i, j)`` into ``root`` (each node points at the least node of its set)."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    return root


class WordCache(dict):
    """``compute(word)`` remembered for up to two generations of ``limit`` words.

    When the newer generation is full it becomes the older one; a word found in
    the older moves on, so frequent words stay.  Long words are not kept.
    """

    def __init__(self, compute: Callable, limit: int, longest: int = 200):
        super().__init__()
        self.compute, self.limit, self.longest, self.older = compute, limit, longest, {}

    def __missing__(self, word):
        value = self.older.pop(word, None)
        if value is None:
            value = self.compute(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


def number_rows(df: DataFrame, weight: str, out: str, key: str) -> DataFrame:
    """Running total of ``weight`` before each row, over the whole table, in no particular but fixed order.

    ``df`` must be a stored table (its rows must not change between reads) and
    ``key`` unique.  Rows are dealt to buckets of about 50,000 by a hash of the
    key; a bucket's rows are summed in one task, and the buckets' totals are
    summed over a table of one row per bucket.
    """
    from pyspark.sql import Window as W

    spark = df.sparkSession
    n = df.count()
    buckets = max(partitions(spark), n // 50_000)
    b, before = free_name(df, "bucket"), free_name(df, "bucket_before")
    dealt = df.withColumn(b, F.pmod(F.xxhash64(key), F.lit(buckets)))
    totals = dealt.groupBy(b).agg(F.sum(weight).alias("bucket_total"))
    sums = totals.select(b, (F.sum("bucket_total").over(W.orderBy(b)) - F.col("bucket_total")).alias(before))
    own = W.partitionBy(b).orderBy(key).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (dealt.withColumn(out, F.sum(weight).over(own) - F.col(weight))
            .join(sums, b).withColumn(out, F.col(out) + F.col(before)).drop(b, before))


def with_running(df: DataFrame, columns: dict[str, tuple[Column, Callable[[Column], Column]]]) -> DataFrame:
    """Add array columns: for every element of an array, the fold of the elements up to and including it.

    ``columns`` maps a new name to the array and to ``fold``, which reduces an
    array.  Blocks of ``ARRAY_BLOCK`` elements are folded first, so an array of m
    elements costs m * ARRAY_BLOCK + (m / ARRAY_BLOCK)^2 steps.  What a lambda reads
    is its own argument, or a column read twice: the optimizer would put any other
    column's expression into the lambda and evaluate it for every element.
    """
    n = {c: [free_name(df, f"{c}_{x}") for x in ("blocks", "folds", "before")] for c in columns}
    empty = F.array().cast("array<array<bigint>>")

    def cut(values: Column) -> Column:
        last = F.ceil(F.size(values) / ARRAY_BLOCK).cast("int") - 1
        return F.when(F.size(values) > 0, F.transform(
            F.sequence(F.lit(0), last), lambda b: F.slice(values, b * ARRAY_BLOCK + 1, F.lit(ARRAY_BLOCK)))).otherwise(empty)

    def earlier(folds: Column, fold: Callable[[Column], Column]) -> Column:
        return F.transform(folds, lambda _, b: fold(F.slice(folds, F.lit(1), b)))

    def total(fold: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
        return lambda values, before: F.transform(values, lambda _, j: fold(
            F.concat(F.array(before), F.slice(values, F.lit(1), j + 1))))

    d = df.withColumns({c: values.cast("array<bigint>") for c, (values, _) in columns.items()})
    d = d.withColumns({n[c][0]: cut(F.col(c)) for c in columns})
    d = d.withColumns({n[c][1]: F.transform(n[c][0], fold) for c, (_, fold) in columns.items()})
    d = d.withColumns({n[c][2]: earlier(F.col(n[c][1]), fold) for c, (_, fold) in columns.items()})
    d = d.withColumns({c: F.flatten(F.zip_with(n[c][0], n[c][2], total(fold))) for c, (_, fold) in columns.items()})
    return d.drop(*[x for names in n.values() for x in names])


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)


def array_max(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: F.greatest(x, y))
