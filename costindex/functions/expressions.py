"""Expression helpers.

Each helper returns a ``Column`` built only from built-in functions, so it
stays inside whole-stage code generation.  The helpers pin down the numeric
and text semantics the pipeline's results depend on (see README, "parity").
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Whitespace as the SQL models use it: the RE2 class \s, which is these five
# characters (Java's \s would also take \x0B, so the class is spelled out).
_WS = "[\\t\\n\\f\\r ]"


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c: ColumnLike, digits: int = 0) -> Column:
    """Round a double to ``digits`` decimals, half away from zero, on the binary value.

    ``F.round`` rounds the decimal text of the double (1.005 -> 1.01); the
    pipeline rounds the binary value scaled by 10**digits (1.005*100 is
    100.49999999999999, so 1.005 -> 1.0).  ``a - floor(a)`` is exact in binary,
    so the half test below is exact too.  Pass a column reference rather than
    a deep expression: the input is used twice.
    """
    x = _col(c).cast("double")
    scale = F.lit(float(10 ** digits))
    a = F.abs(x) * scale
    f = F.floor(a).cast("double")
    r = F.when((a - f) >= F.lit(0.5), f + F.lit(1.0)).otherwise(f)
    return F.signum(x) * r / scale


def collapse_whitespace(c: ColumnLike, all_runs: bool = False) -> Column:
    """Replace whitespace runs by one space.

    By default only the FIRST run is replaced, which is what the SQL models
    compute (a regexp replace without the global flag); ``all_runs=True``
    collapses every run.
    """
    if all_runs:
        return F.regexp_replace(_col(c), _WS + "+", " ")
    return F.regexp_replace(_col(c), "^((?s).*?)" + _WS + "+", "$1 ")


def to_int_half_even(c: ColumnLike) -> Column:
    """double -> int rounding half to even (``cast`` alone truncates)."""
    return F.rint(_col(c).cast("double")).cast("int")


def month_text(c: ColumnLike) -> Column:
    """'YYYY-MM' text of a date or timestamp; sorts and compares as text."""
    return F.date_format(F.to_date(_col(c)), "yyyy-MM")


def number_or_null(c: ColumnLike) -> Column:
    """The value as a double; NaN and text that is no number are null."""
    x = _col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def year_text(c: ColumnLike) -> Column:
    return F.date_format(F.to_date(_col(c)), "yyyy")


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """num / den as double, null when den is 0 or null (never raises under ANSI)."""
    d = _col(den).cast("double")
    return F.when(d != F.lit(0.0), _col(num).cast("double") / d)


def is_in_ci(c: ColumnLike, values: Iterable[str]) -> Column:
    """Case-insensitive membership (lower(c) in lowered values)."""
    return F.lower(_col(c)).isin([v.lower() for v in values])


def label_lookup(c: ColumnLike, labels: Mapping[str, str]) -> Column:
    """Map a code to a label; codes without a label pass through unchanged."""
    if not labels:
        return _col(c)
    pairs = []
    for k, v in labels.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[_col(c)], _col(c))


def py_str_double(c: ColumnLike) -> Column:
    """Text of a double the way Python's ``str(float)`` writes it.

    Java writes plain decimals for 1e-3 <= |x| < 1e7 and ``d.dE±n`` otherwise;
    Python uses plain decimals for 1e-4 <= |x| < 1e16 and ``de±nn`` otherwise.
    Both print the shortest round-trip digits, so only the layout is changed.
    """
    x = _col(c).cast("double")
    a = F.abs(x)
    java = x.cast("string")
    # plain layout from the exact decimal of the shortest digits
    plain = F.regexp_replace(x.cast("decimal(38,18)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mant = F.regexp_replace(F.regexp_extract(java, "^(-?[0-9.]+)E", 1), "\\.0$", "")
    expo = F.regexp_extract(java, "E(-?[0-9]+)$", 1).cast("int")
    sci = F.concat(mant, F.lit("e"), F.when(expo < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.lpad(F.abs(expo).cast("string"), 2, "0"))
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(a == F.lit(float("inf")), F.when(x > 0, F.lit("inf")).otherwise(F.lit("-inf")))
            .when((a == 0) | ((a >= 1e-3) & (a < 1e7)), java)
            .when(((a >= 1e-4) & (a < 1e-3)) | ((a >= 1e7) & (a < 1e16)), plain)
            .otherwise(sci))


def _split(a: Column) -> tuple[Column, Column]:
    """Veltkamp split of a double into two halves of 26 bits each."""
    t = F.lit(134217729.0) * a
    hi = t - (t - a)
    return hi, a - hi


def fused_multiply_add(a: ColumnLike, b: ColumnLike, c: ColumnLike) -> Column:
    """a*b + c with the product kept exact before the single final addition.

    Dekker's error-free product gives a*b = p + e exactly; the sum is then
    formed as (p + c) plus the two error terms.  This reproduces a hardware
    fused multiply-add (one rounding) for the interpolation below.
    """
    a, b, c = _col(a).cast("double"), _col(b).cast("double"), _col(c).cast("double")
    p = a * b
    ahi, alo = _split(a)
    bhi, blo = _split(b)
    e = ((ahi * bhi - p) + ahi * blo + alo * bhi) + alo * blo
    s = p + c
    bb = s - p
    s_err = (p - (s - bb)) + (c - bb)
    return s + (s_err + e)


def interpolate(lo: ColumnLike, hi: ColumnLike, frac: ColumnLike) -> Column:
    """Linear interpolation lo*(1-f) + hi*f with one rounding (continuous percentile)."""
    lo, hi, frac = _col(lo), _col(hi), _col(frac).cast("double")
    return F.when((frac == 0) | (lo == hi), lo).otherwise(
        fused_multiply_add(lo, F.lit(1.0) - frac, hi * frac))


def ntz(moment) -> Column:
    """A zone-free timestamp literal (independent of the session time zone)."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
