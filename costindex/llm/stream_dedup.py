"""Exact deduplication as a stateful stream.

Every file of a Parquet table passes once through a stream whose keyed state,
kept on disk by the RocksDB state store, never expires.  For a content digest
the state retains the stable identifier (the largest id seen), the content
locator (file and row of that document) and the number of rows.  A later call
with the same ``state_path`` reads only files that were not there before.

A digest alone proves nothing: of every digest with several rows (a hit) the
whole text of each row is compared with the content at the retained locator.
Where one differs, the rows of that digest are told apart by their whole texts,
so any digest function gives right results, a weak one only slower.

Copies are aggregated before the shuffle into the state, which holds no text.
For the comparison texts are shuffled once by digest; a digest with more than
1/``SPREAD`` of all rows is dealt to several buckets, and at most ``SPREAD``
digests can be such, which bounds what is broadcast.

Defined results: null and empty texts are equal; of equal texts the row with the
largest id stays, of equal ids (repeated rows) the one last in file order, and a
null id comes before any other; rows whose ids and texts are equal are rows of
their own; very long texts are compared whole; an empty table gives an empty
one.  Only the id and the text column are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from costindex.llm.common import stage, text_or_empty
from costindex.session import shared_root

#: A digest with more than this share (1 in SPREAD) of all rows is dealt to several buckets.
SPREAD = 1024
FILES_PER_BATCH = 10_000
ENTRIES = "digest binary, at struct<doc_id:{id},file:string,row:long>, n long"
# Settings of the state store, read when the stream starts.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # an executor keeps the files of a state partition (several MB even when empty) only while a task works on it
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _located(df: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text, digest and the locator of every row of a Parquet scan or stream."""
    meta = df.metadataColumn("_metadata")
    text = text_or_empty(F.col(text_col).cast("string"))
    return df.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), digest(text).alias("digest"),
        meta["file_path"].alias("file"), meta["row_index"].alias("row"))


def _one_path(path: str) -> str:
    """``path`` as a pattern that matches it alone: a stream cannot start from the plain path of one file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def update_state(spark: SparkSession, path: str, state_path: str, digest: Callable[[Column], Column] = sha256,
                 id_col: str = "doc_id", text_col: str = "text", files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Pass new files of the table at ``path`` through the state; returns its entries: digest, at, n.

    A micro-batch writes the entries that it changed to a folder of its own, which
    a repeated batch replaces; identifier and count only grow, so the largest is
    the state's.
    """
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(_one_path(path))
    state = (_located(stream, id_col, text_col, digest)
             .groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("at"), F.count(F.lit(1)).alias("n")))

    def publish(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{state_path}/entries/batch={batch}")

    with _settings(spark, STATE_STORE):
        run = (state.writeStream.outputMode("update").option("checkpointLocation", f"{state_path}/checkpoint")
               .trigger(availableNow=True).foreachBatch(publish).start())
        run.awaitTermination()
    entries = ENTRIES.format(id=schema[id_col].dataType.simpleString())
    try:
        log = spark.read.schema(entries).parquet(f"{state_path}/entries/batch=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], entries)
    return stage(log.groupBy("digest").agg(F.max("at").alias("at"), F.max("n").alias("n")), "dedup-entries")


def _buckets(n: Column, hot_above: int) -> Column:
    return F.when(n > hot_above, F.ceil(n / F.lit(hot_above))).otherwise(F.lit(1)).cast("int")


def _dealt(rows: DataFrame, entries: DataFrame, hot_above: int) -> DataFrame:
    """Add ``bucket``: rows of a digest with more than ``hot_above`` rows are dealt by their place."""
    hot = F.broadcast(entries.filter(F.col("n") > hot_above).select(  # at most SPREAD rows, see the caller
        "digest", _buckets(F.col("n"), hot_above).alias("buckets")))
    place = F.pmod(F.xxhash64("file", "row"), F.coalesce("buckets", F.lit(1)))
    return rows.join(hot, "digest", "left").withColumn("bucket", place.cast("int")).drop("buckets")


def _repeated(per_digest: DataFrame, hot_above: int) -> DataFrame:
    """A row of ``per_digest`` (with ``n``) for every bucket of its digest."""
    return per_digest.withColumn("bucket", F.explode(F.sequence(F.lit(0), _buckets(F.col("n"), hot_above) - 1)))


def exact_duplicates(spark: SparkSession, path: str, state_path: str | None = None,
                     digest: Callable[[Column], Column] = sha256, id_col: str = "doc_id", text_col: str = "text",
                     files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the id of the row that stays of its equal texts.  Without
    ``state_path`` the state is a new one under the shared folder.
    """
    state_path = state_path or f"{shared_root(spark)}/dedup-state"
    entries = update_state(spark, path, state_path, digest, id_col, text_col, files_per_batch)
    total = entries.agg(F.sum("n")).first()[0] or 0
    hot_above = max(1, total // SPREAD)  # exceeded by fewer than SPREAD + 1 digests, as their counts add up to total
    docs = _dealt(_located(spark.read.parquet(path), id_col, text_col, digest), entries, hot_above)

    # full bytes on hits: each row against the content at its digest's locator
    hits = _repeated(entries.filter(F.col("n") > 1), hot_above)
    members = stage(docs.join(hits, ["digest", "bucket"]), "dedup-members")
    place = (F.col("file") == F.col("at.file")) & (F.col("row") == F.col("at.row"))
    retained = _repeated(members.filter(place).select("digest", "n", F.col("text").alias("retained")), hot_above)
    differ = stage(members.join(retained.drop("n"), ["digest", "bucket"]).filter(F.col("text") != F.col("retained"))
                   .select("digest").distinct(), "dedup-collisions")

    sha = F.sha2("text", 256).alias("text_sha256")
    keyed = docs.select("doc_id", "digest", "bucket", "file", "row", sha)
    classes = entries
    if not differ.isEmpty():
        classes = entries.join(differ, "digest", "left_anti")
    found = keyed.join(_repeated(classes, hot_above), ["digest", "bucket"])
    if classes is not entries:
        apart = members.drop("at", "n", "bucket").join(differ, "digest")
        whole = apart.groupBy("digest", "text").agg(
            F.max(F.struct("doc_id", "file", "row")).alias("at"), F.count(F.lit(1)).alias("n"))
        found = found.select("doc_id", "file", "row", "at", "n", "text_sha256").unionByName(
            apart.join(whole, ["digest", "text"]).select("doc_id", "file", "row", "at", "n", sha))
    return found.select("doc_id", F.col("at.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                        place.alias("kept"), "text_sha256")


DUPLICATES_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""
