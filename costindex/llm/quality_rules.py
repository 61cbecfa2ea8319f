"""Quality rules whose cutoffs are certified on labelled documents.

Counts of every whole text feed four rules; a rule's score is an integer rate
(parts per thousand) and the rule rejects scores above its cutoff.  Which cutoff
a rule may use is decided per stratum (language) on labelled documents:

- a false rejection is a document labelled good that the cutoff rejects;
- with ``n`` good labelled documents in the stratum, ``k`` of them rejected, the
  exact binomial test of "the false rejection rate is at least ``risk``" has the
  p-value P(Bin(n, risk) <= k); equivalently the Clopper-Pearson upper bound at
  that level is below ``risk``;
- the cutoffs of one rule and stratum are tested in a fixed order, loosest
  first, until the first that fails (fixed-sequence testing needs no division
  of the level), and the level is divided by rules times strata (Bonferroni).

With probability 1 - ``delta``, no cutoff in use has a false rejection rate above
``risk`` in any stratum; four rules together stay below four times ``risk``.  Of the
certified cutoffs the one that rejects most bad minus good labelled documents
is used, the loosest at a tie; a rule without a gain or without enough labelled
documents does not reject there.

Defined results: a null text has no words and fails the base rule; null and
empty strata are one stratum; a document labelled both good and bad counts as
good; labels that are null, neither 0 nor 1, or of unknown documents are
ignored; documents without an id are judged but cannot be labelled; repeated
rows are judged one by one.  Without labels only the base rule rejects.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from costindex.llm.common import ASCII_SPACE, append_columns, free_name, stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
RISK = 0.005
DELTA = 0.05
RATES = (0, 1, 2, 5, 10, 20, 30, 50, 75, 100, 150, 200, 250, 300, 400, 500, 600, 700, 800, 900)
#: Rule: (numerator, denominator, cutoffs in parts per thousand).
RULES = {
    "symbols": ("n_symbols", "word_chars", RATES),
    "dup_lines": ("n_dup_lines", "n_lines", RATES),
    "repeats": ("n_repeat_words", "n_words", RATES),
    "long_words": ("word_chars", "n_words", tuple(range(4000, 16000, 500))),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeat_words(words: list) -> int:
    """Words inside 3-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    width = len(known)
    if width == n:
        return 0
    windows = ids[:-2] * width + ids[1:-1]
    if width >= 1 << 20:
        windows = np.unique(windows, return_inverse=True)[1]
    windows = windows * width + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(n, bool)
    hit = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        twice[hit + k] = True
    return int(twice.sum())


def text_counts(text: str) -> tuple[int, ...]:
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    return (len(words), len(text) - sum(map(text.count, ASCII_SPACE)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines))


def with_counts(df: DataFrame, text_col: str, names: dict[str, str] | None = None) -> DataFrame:
    """Add the six counts (``names`` maps a count to its column name)."""
    names = names or {}
    fields = [(names.get(c, c), pa.int64(), "long") for c in COUNTS]
    return append_columns(df, text_col, fields, lambda texts: list(zip(*map(text_counts, texts))))


def base_failed(c) -> Column:
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def score(rule: str, c) -> Column:
    top, bottom, _ = RULES[rule]
    return F.when(c(bottom) > 0, F.floor(c(top) * 1000 / c(bottom))).otherwise(F.lit(0)).cast("long")


def cutoffs_below(value: Column, cuts: tuple[int, ...]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda t: value > t))


def at_most(n: int, risk: float, k: int) -> float:
    """P(Bin(n, risk) <= k), exact up to rounding; 1.0 where k is at or above the mean (never significant)."""
    if n == 0 or k >= n * risk:
        return 1.0
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                    + k * math.log(risk) + (n - k) * math.log1p(-risk))
    total = term
    for i in range(k, 0, -1):
        term *= i / (n - i + 1) * (1 - risk) / risk
        total += term
        if term < total * 1e-18:
            break
    return total


def choose(good: np.ndarray, bad: np.ndarray, cutoffs: tuple[int, ...], risk: float, level: float) -> int | None:
    """The cutoff to use.  ``good[i]``/``bad[i]``: labelled documents whose score is above the i-th cutoff only up to the next."""
    n = int(good.sum())
    above_good, above_bad = (v[::-1].cumsum()[::-1][1:] for v in (good, bad))  # rejected by cutoff i
    best, gain = None, 0
    for i in range(len(cutoffs) - 1, -1, -1):
        if at_most(n, risk, int(above_good[i])) > level:
            break
        if above_bad[i] - above_good[i] > gain:
            best, gain = cutoffs[i], int(above_bad[i] - above_good[i])
    return best


def certified_cutoffs(judged: DataFrame, labels: DataFrame, id_col: str, stratum: Column, c,
                      risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum that has good labels: stratum and a cutoff (or null) per rule.

    ``judged`` has the counts (``c(name)`` finds them) and must be stored.
    """
    known = (labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("label_id"))
             .agg(F.max("quality").alias("label")))
    scored = judged.filter(~base_failed(c)).select(
        F.col(id_col).alias("label_id"), stratum.alias("stratum"),
        F.array(*[F.struct(F.lit(r).alias("rule"), cutoffs_below(score(r, c), cuts).alias("above"))
                  for r, (_, _, cuts) in RULES.items()]).alias("rules"))
    counted = stage(
        scored.join(known, "label_id").select("stratum", "label", F.explode("rules").alias("r"))
        .groupBy("stratum", F.col("r.rule").alias("rule"), F.col("r.above").alias("above"))
        .agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad")), "quality-counts")
    strata = counted.filter("good > 0").agg(F.count_distinct("stratum")).first()[0]
    level = delta / max(1, strata * len(RULES))

    def pick(pdf):
        out = {"stratum": [pdf["stratum"].iloc[0]]}
        for r, (_, _, cuts) in RULES.items():
            good, bad = np.zeros(len(cuts) + 1, np.int64), np.zeros(len(cuts) + 1, np.int64)
            own = pdf[pdf["rule"] == r]
            good[own["above"]], bad[own["above"]] = own["good"], own["bad"]
            out[r] = [choose(good, bad, cuts, risk, level)]
        return pa.table(out).to_pandas(integer_object_nulls=True).astype({r: object for r in RULES})

    cut = ", ".join(f"{r} long" for r in RULES)
    return stage(counted.groupBy("stratum").applyInPandas(pick, f"stratum string, {cut}"), "quality-cutoffs")


def _verdicts(judged: DataFrame, labels: DataFrame, id_col: str, stratum_col: str, c, kept: str) -> DataFrame:
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit(""))
    cuts = certified_cutoffs(judged, labels, id_col, stratum, c).select(
        F.col("stratum").alias("cut_stratum"), F.struct(*RULES).alias("cut_values"))
    key = free_name(judged, "stratum_key")
    passed = ~base_failed(c)
    for r in RULES:
        passed &= F.coalesce(score(r, c) <= F.col(f"cut_values.{r}"), F.lit(True))
    return (judged.withColumn(key, stratum).join(cuts, F.col(key) == F.col("cut_stratum"), "left")
            .withColumn(kept, passed).drop(key, "cut_stratum", "cut_values"))


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     stratum_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).alias("stratum"), F.col(text_col).alias("text"))
    judged = stage(with_counts(own, "text").drop("text"), "quality-judged")
    out = _verdicts(judged, labels, "doc_id", "stratum", F.col, "kept")
    return out.select("doc_id", *COUNTS[:-1], base_failed(F.col).alias("base_failed"), "kept")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              stratum_col: str = "lang") -> DataFrame:
    """``docs`` without the rejected rows."""
    names = {n: free_name(docs, f"count_{n}") for n in COUNTS}
    judged = stage(with_counts(docs, text_col, names), "quality-docs")
    kept = free_name(judged, "row_kept")
    return _verdicts(judged, labels, id_col, stratum_col, lambda n: F.col(names[n]), kept).filter(kept).select(*docs.columns)


#: DuckDB SQL of the verdicts; ``quality_docs`` is the name of the input relation.
def verdict_sql(source: str = "documents") -> str:
    rule_rows = " union all ".join(
        f"select doc_id, rn, lang, base_failed, '{r}' as rule, case when {b} > 0 then ({t} * 1000) // {b} else 0 end as score from counts"
        for r, (t, b, _) in RULES.items())
    grid = ", ".join(f"('{r}', {t})" for r, (_, _, cuts) in RULES.items() for t in cuts)
    space = r"\x20\x09-\x0D"
    return f"""
with base as (select doc_id, coalesce(lang, '') as lang, coalesce(text, '') as text, row_number() over () as rn from {source}),
words as (select rn, unnest(regexp_extract_all(text, '[^{space}]+')) as w, generate_subscripts(regexp_extract_all(text, '[^{space}]+'), 1) as pos from base),
grams as (select rn, pos, w, lead(w, 1) over d as w2, lead(w, 2) over d as w3 from words window d as (partition by rn order by pos)),
twice as (select rn, pos from (select rn, pos, count(*) over (partition by rn, w, w2, w3) as c from grams where w3 is not null) where c > 1),
covered as (select rn, count(distinct p) as n from (select rn, unnest([pos, pos + 1, pos + 2]) as p from twice) group by rn),
counts as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words as base_failed from (
    select b.doc_id, b.rn, b.lang,
      len(regexp_extract_all(text, '[^{space}]+'))::bigint as n_words,
      length(regexp_replace(text, '[{space}]', '', 'g'))::bigint as word_chars,
      (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
      (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
      coalesce(c.n, 0)::bigint as n_repeat_words, len(lines)::bigint as n_lines
    from (select *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^{space}]')) as lines from base) b
    left join covered c on b.rn = c.rn)),
scores as ({rule_rows}),
label as (select doc_id, max(quality) as label from labels where quality in (0, 1) group by doc_id),
grid(rule, cutoff) as (values {grid}),
marked as (select s.lang, s.rule, s.score, l.label from scores s join label l on s.doc_id = l.doc_id where not s.base_failed),
level as (select {DELTA} / greatest(1, {len(RULES)} * count(distinct lang)) as level from marked where label = 1),
tried as (
  select m.lang, g.rule, g.cutoff, count(*) filter (label = 1) as n,
    count(*) filter (label = 1 and score > cutoff) as k, count(*) filter (label = 0 and score > cutoff) as bad
  from marked m join grid g on m.rule = g.rule group by all),
tested as (
  select *, case when n = 0 or k >= n * {RISK} then 1.0 else
    list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({RISK}) + (n - i) * ln(1 - {RISK})))) end as p
  from tried),
certified as (
  select t.* from tested t where not exists (
    select 1 from tested f, level where f.lang = t.lang and f.rule = t.rule and f.cutoff >= t.cutoff and f.p > level.level)),
cuts as (
  select lang, rule, cutoff from (
    select *, row_number() over (partition by lang, rule order by bad - k desc, cutoff desc) as r from certified where bad > k) where r = 1),
hit as (select distinct s.rn from scores s join cuts c on s.lang = c.lang and s.rule = c.rule and s.score > c.cutoff)
"""


def verdict_sql_query(source: str = "documents") -> str:
    return verdict_sql(source) + f"""select c.doc_id, c.{', c.'.join(COUNTS[:-1])}, c.base_failed,
  not c.base_failed and h.rn is null as kept
from counts c left join hit h on c.rn = h.rn"""
