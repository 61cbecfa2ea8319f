"""Token counts through a digest cache.

Key: SHA-256 of the normalised content and a digest of the tokenizer version
(model bytes, library version, options).  Normalisation is null to empty and
nothing else: whatever the tokenizer itself does not fold may change the count.
Documents are joined to the stored counts; one text of each digest without a
count is encoded, and its count is appended to the cache (a Parquet table, so
a failed job appends nothing).  Copies are removed before and after the shuffle
by partial aggregation, so a hot text costs one row per task.

Counting is exact by words: in a model whose pieces never have a space mark
behind another character, merges cannot cross the start of a run of spaces, so
the count of a text is the sum over its runs-with-word, and those repeat.  For
any other model whole texts are encoded.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows
get a row each; an empty table gives an empty one; counts that two jobs append
for one digest are equal, and one is read.
"""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import WordCache, stage, text_or_empty
from costindex.session import shared_root

LIMIT = 4096
CACHE = 250_000
SPACE = "▁"
COUNTS = "content_digest string, tokenizer_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of what the counts depend on: the file, the library and the options."""
    name = "sentencepiece" if path.endswith(".model") else "tokenizers"
    library = __import__(name)
    options = f"{name} {library.__version__} add_special_tokens=False no truncation no padding"
    return hashlib.sha256(Path(path).read_bytes() + options.encode()).hexdigest()


class PieceCounts:
    """Number of pieces of a text, by runs of spaces (but the first) with the word behind."""

    def __init__(self, path: str, limit: int = CACHE):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.runs = re.compile(" +[^ ]*")
        self.by_word = not any(SPACE in self.model.id_to_piece(i).lstrip(SPACE) for i in range(self.model.get_piece_size()))
        # a lone space mark is one piece; the model writes no mark before an empty text
        self.words = WordCache(lambda word: len(self.model.encode(word)) if word else 1, limit, 100)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word:
            return len(self.model.encode(text))
        if SPACE in text:
            text = text.replace(SPACE, " ")
        words = text.split(" ")
        if "" in words:  # runs of spaces, or spaces at an end
            words = [r[1:] for r in self.runs.findall(" " + text)]
        return sum(map(self.words.__getitem__, words))


class JsonCounts:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, text: str) -> int:
        return len(self.model.encode(text, add_special_tokens=False).ids)


_COUNTERS: dict[str, PieceCounts | JsonCounts] = {}


def counter(path: str):
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounts(path) if path.endswith(".model") else JsonCounts(path)
    return _COUNTERS[path]


def _encode(misses: DataFrame, path: str, version: str) -> DataFrame:
    def run(batches):
        c = counter(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([version] * b.num_rows, pa.string()),
                 pa.array([c.count(t) for t in b.column(1).to_pylist()], pa.int64())],
                names=["content_digest", "tokenizer_digest", "n_tokens"])

    return misses.select("content_digest", "text").mapInArrow(run, COUNTS)


def _stored(spark, cache_path: str, version: str) -> DataFrame:
    """The cache's counts for this tokenizer, one row per digest; empty when there is no cache yet."""
    try:
        cache = spark.read.schema(COUNTS).parquet(cache_path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.range(0).select(F.lit("").alias("content_digest"), F.col("id").alias("n_tokens"))
    return (cache.filter(F.col("tokenizer_digest") == version)
            .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    ``cache_path`` names a cache to keep; without it a new one is made under the shared folder.
    """
    spark = docs.sparkSession
    cache_path = cache_path or shared_root(spark) + "/token-cache"
    version = tokenizer_digest(tokenizer_path)
    text = text_or_empty(F.col(text_col))
    digest = F.sha2(text, 256).alias("content_digest")
    unknown = docs.select(digest, text.alias("text")).join(
        _stored(spark, cache_path, version).select("content_digest"), "content_digest", "left_anti")
    _encode(unknown.dropDuplicates(["content_digest"]), tokenizer_path, version).write.mode("append").parquet(cache_path)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest)
    # stored once more without the aggregation, so that the join can split a digest with very many rows
    counts = stage(_stored(spark, cache_path, version), "token-counts")
    return (keyed.join(counts, "content_digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
