"""Column expressions shared by every layer (all JVM-side, codegen friendly)."""

from costindex.functions.expressions import (  # noqa: F401
    collapse_whitespace,
    fused_multiply_add,
    interpolate,
    is_in_ci,
    label_lookup,
    month_text,
    ntz,
    number_or_null,
    number_or_null, py_str_double,
    round_half_away,
    safe_ratio,
    to_int_half_even,
    year_text,
)
