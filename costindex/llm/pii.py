"""Personal data by pattern, checksum and context, with DataFrame functions only.

A kind of personal data is a ``Kind``: a regular expression proposes spans, an
optional validator confirms them (Luhn, mod-97, value ranges), and words nearby
raise or lower the score.  Base kinds always stay once validated; other kinds
stay when their score reaches ``THRESHOLD``.

Positions come from splitting the text by the pattern and extracting the
matches: a match starts after all earlier pieces and matches.  The running sums
are taken in blocks, so a text with very many matches costs m * 64 + (m / 64)^2
steps, not m^2; redaction cuts the text into blocks once, so that a piece between
two spans costs its length and no walk from the text's start.  Everything runs in
the row, without a shuffle.

The patterns of the base kinds equal the contract's: possessive quantifiers
(which cannot recurse or backtrack on long runs) are used only where the next
character cannot belong to the run.  A local part may start where the last
match ended or after a character that cannot be part of one; other starts
inside a run would fail like the run's first.

Defined results: null and empty texts have no spans; positions are code points,
end exclusive; spans of different kinds may overlap; redaction replaces the
union of the spans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from costindex.llm.common import array_max, array_sum, free_name, with_running

THRESHOLD = 0.8
#: Characters before and after a span in which context words count.
CONTEXT = 48
#: Code points of a block in which redaction looks up the pieces that stay.
TEXT_BLOCK = 1024

SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: float
    needs: str | None = None                      # a text without this string has no match
    valid: Callable[[Column], Column] | None = None
    context: str | None = None                    # words that raise the score
    against: str | None = None                    # words that lower it
    base: bool = False


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _digit_at(d: Column, pos: Column) -> Column:
    return F.ascii(F.substr(d, pos, F.lit(1))) - 48


def luhn(d: Column) -> Column:
    """True when the digit string ``d`` passes the Luhn checksum."""
    def step(total, i):
        v = _digit_at(d, F.length(d) - i)
        twice = v * 2
        return total + F.when(i % 2 == 0, v).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """True when an account code (letters and digits, country first) leaves 1 modulo 97 (ISO 7064)."""
    turned = F.concat(F.substr(code, F.lit(5)), F.substr(code, F.lit(1), F.lit(4)))

    def step(rest, i):
        a = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(a < 58, (rest * 10 + a - 48) % 97).otherwise((rest * 100 + a - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _length_in(d: Column, lo: int, hi: int) -> Column:
    return F.length(d).between(lo, hi)


def _compact(m: Column) -> Column:
    return F.replace(m, F.lit(" "), F.lit(""))


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOCAL = "[A-Za-z0-9._%+-]"

#: Length of an account code by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}


def _iban() -> str:
    """Account codes of exactly their country's length, whatever follows; those of other countries as long as they go."""
    known = "|".join(" ".join(IBAN_LENGTHS.values()).split())
    exact = [f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
             for n, c in IBAN_LENGTHS.items()]
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:(?! (?:{known})[0-9]{{2}}) ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*exact, other])})(?![A-Za-z0-9])"


#: Base kinds (patterns fixed by the contract) in listed order, then the added kinds.
KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, needs="@", base=True),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.7, needs=".", base=True,
         valid=lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
         context=r"\b(ip|host|server|address|adresse)\b", against=r"\b(version|release|section)\b"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.8, base=True,
         valid=lambda m: _length_in(_digits(m), 16, 19) & luhn(_digits(m)),
         context=r"\b(card|visa|mastercard|credit|debit|karte|carte|tarjeta)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.8, needs="+", base=True,
         valid=lambda m: _length_in(_digits(m), 8, 15),
         context=r"\b(phone|tel|call|mobile|fax|telefon|telefono)\b"),
    Kind("iban", _iban(), 0.85,
         valid=lambda m: _length_in(_compact(m), 15, 34) & mod97(_compact(m)),
         context=r"\b(iban|account|konto|compte|cuenta|bank|bic)\b"),
    Kind("short_card", r"(?<![0-9A-Za-z+.-])[0-9](?:[ -]?[0-9]){12,14}(?![ -]?[0-9A-Za-z])", 0.6,
         valid=lambda m: luhn(_digits(m)),
         context=r"\b(card|visa|amex|american express|credit|debit|karte|carte|tarjeta)\b"),
    Kind("local_phone", r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![ .-]?[0-9A-Za-z])", 0.5,
         valid=lambda m: _length_in(_digits(m), 8, 13),
         context=r"\b(phone|tel|call me|mobile|fax|telefon|t[ée]l[ée]phone|tel[ée]fono)\b"),
    Kind("national_id", r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])", 0.6, needs="-",
         context=r"\b(ssn|social security|national id|id number)\b"),
    Kind("secret", r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])", 0.6,
         context=r"\b(token|secret|password|passwd|api[ _-]?key|apikey)\b", against=r"\b(sha|md5|commit|checksum|digest)\b"),
)
BASE = tuple(k.name for k in KINDS if k.base)


def with_spans(df: DataFrame, text_col: str = "text", out: str = "spans", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Add ``out``: the spans of all kinds, by kind as listed, then start."""
    tag = free_name(df, "pii_found")
    text = F.col(text_col)
    col = lambda part, k: f"{tag}_{part}_{k.name}"
    none = F.array().cast("array<string>")
    named = {k.name: k for k in kinds}

    def step(d: DataFrame, part: str, make: Callable[[Kind], Column]) -> DataFrame:
        # one projection for all kinds: what it reads is a column, so nothing is computed twice
        return d.withColumns({col(part, k): make(k) for k in named.values()})

    def found(k: Kind) -> Column:
        has = text.isNotNull() if k.needs is None else F.coalesce(F.contains(text, F.lit(k.needs)), F.lit(False))
        return F.when(has, F.regexp_extract_all(text, F.lit(k.pattern), 0)).otherwise(none)

    def length(x: Column) -> Column:
        return F.length(x).cast("bigint")

    def shifted(values: Column) -> Column:
        return F.concat(F.array(F.lit("")), F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0))))

    def nearby(k: Kind) -> Column:
        """The text around each match, past one earlier match of the kind, as lists of numbers share their heading."""
        if not (k.context or k.against):
            return none
        hits, pieces = F.col(col("found", k)), F.col(col("pieces", k))
        ahead = F.zip_with(shifted(F.slice(pieces, F.lit(1), F.size(hits))), shifted(hits),
                           lambda piece, hit: F.concat(F.right(piece, F.lit(CONTEXT)), hit))
        ahead = F.zip_with(ahead, F.slice(pieces, F.lit(1), F.size(hits)),
                           lambda earlier, piece: F.right(F.concat(earlier, F.right(piece, F.lit(CONTEXT))), F.lit(CONTEXT)))
        return F.zip_with(ahead, F.slice(pieces, F.lit(2), F.size(hits)),
                          lambda before, piece: F.lower(F.concat(before, F.lit(" "), F.left(piece, F.lit(CONTEXT)))))

    def spans(k: Kind) -> Column:
        placed = F.zip_with(col("found", k), col("ends", k), lambda m, end: F.struct(m.alias("text"), end.alias("end")))

        def scored(m, near):
            s = F.lit(k.score)
            if k.context:
                s = s + F.when(near.rlike(k.context), 0.3).otherwise(0.0)
            if k.against:
                s = s - F.when(near.rlike(k.against), 0.3).otherwise(0.0)
            ok = k.valid(m["text"]) if k.valid else F.lit(True)
            return F.when(ok, F.struct(F.lit(k.name).alias("kind"), (m["end"] - length(m["text"])).alias("start"),
                                       m["end"].alias("end"), F.least(F.lit(1.0), s).alias("score")))

        stays = (lambda s: s.isNotNull()) if k.base else (lambda s: s.isNotNull() & (s["score"] >= THRESHOLD))
        return F.filter(F.zip_with(placed, col("near", k), scored), stays)

    d = step(df, "found", found)
    d = step(d, "pieces", lambda k: F.when(F.size(col("found", k)) > 0, F.split(text, k.pattern, -1)).otherwise(none))
    d = step(d, "near", nearby)
    d = with_running(d, {col("ends", k): (F.zip_with(
        col("found", k), F.slice(col("pieces", k), F.lit(1), F.size(col("found", k))), lambda m, piece: length(m) + length(piece)), array_sum)
        for k in named.values()})
    d = step(d, "spans", spans)
    d = d.withColumn(out, F.concat(*[F.col(col("spans", k)) for k in named.values()]).cast(SPANS))
    return d.select(*df.columns, out)


def listed(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` joined by commas."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts per base kind, base_sha256, spans, n_added."""
    d = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", "found_spans")
    spans = F.col("found_spans")
    count = lambda name: F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("bigint")
    return d.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(spans, BASE), 256).alias("base_sha256"), listed(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: ~s["kind"].isin(*BASE))).cast("bigint").alias("n_added"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets.

    Overlapping spans become one, named after the first.  ``length_col``, when
    the table has it, gets the new length of changed texts.
    """
    tag = free_name(docs, "pii_redact")
    s, blocks, ends, new = (f"{tag}_{x}" for x in ("spans", "blocks", "ends", "text"))
    text = F.col(text_col)
    d = with_spans(docs, text_col, s)
    d = d.withColumn(s, F.array_sort(F.transform(s, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))))
    d = with_running(d, {ends: (F.transform(s, lambda x: x["end"]), array_max)})
    changed = F.size(s) > 0
    d = d.withColumn(blocks, F.when(changed, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))))

    def between(start: Column, end: Column) -> Column:
        first = F.floor(start / TEXT_BLOCK).cast("int")
        n = F.floor((end - 1) / TEXT_BLOCK).cast("int") - first + 1
        own = F.array_join(F.slice(F.col(blocks), first + 1, n), "")
        return F.when(end > start, F.substr(own, (start - first * TEXT_BLOCK + 1).cast("int"), (end - start).cast("int"))).otherwise(F.lit(""))

    def kept(x, done):
        return F.when(x["start"] >= done, F.concat(between(done, x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(F.lit(""))

    zero = F.array(F.lit(0).cast("bigint"))
    earlier = F.concat(zero, F.slice(F.col(ends), F.lit(1), F.greatest(F.size(ends) - 1, F.lit(0))))
    last = F.element_at(F.col(ends), -1)
    d = d.withColumn(new, F.when(changed, F.concat(
        F.array_join(F.zip_with(s, earlier, kept), ""), between(last, F.length(text).cast("bigint")))).otherwise(text))
    cols = {text_col: F.col(new)}
    if length_col and length_col in docs.columns:
        cols[length_col] = F.when(changed, F.length(new).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col))
    return d.withColumns(cols).select(*docs.columns)
