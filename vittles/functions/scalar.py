"""Scalar column expressions.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen.  Each takes and returns ``Column`` objects; column names are always
arguments.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number as text: optional sign, digits with optional fraction, optional exponent.
NUMERIC_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN and +-inf become NULL (pandas skips NaN; Spark aggregates do not)."""
    c = col_(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("double")).otherwise(c)


def to_double(c: str | Column) -> Column:
    """Text -> double; anything that is not a plain number becomes NULL.

    ``try_cast`` alone accepts Java suffixes such as ``5d``; the regex guard
    keeps the pandas ``to_numeric(errors="coerce")`` contract.
    """
    c = col_(c)
    s = F.trim(c.cast("string"))
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def to_double_strict(c: str | Column) -> Column:
    """Text -> double; text that is not a number raises (NULL stays NULL)."""
    c = col_(c)
    s = F.trim(c.cast("string"))
    bad = c.isNotNull() & ~s.rlike(NUMERIC_TEXT)
    return F.when(bad, F.raise_error(F.concat(F.lit("not a number: "), s))).otherwise(s.try_cast("double"))


def to_long_id(c: str | Column) -> Column:
    """Ids coerced through double, so ``"12.0"`` is a valid id."""
    d = to_double(c)
    return F.when(d == F.floor(d), d.cast("long"))


def blank_to_null(c: str | Column) -> Column:
    """F6 helper: ``nullif(trim(c), '')``."""
    c = col_(c)
    return F.when(F.trim(c) != "", c)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """F8/Q15: clip that keeps NULL as NULL (``greatest``/``least`` skip nulls)."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(float(lo)))
    if hi is not None:
        out = F.least(out, F.lit(float(hi)))
    return F.when(c.isNotNull(), out)


def capped_percent(c: str | Column, reference: float) -> Column:
    """(value / reference) * 100, clipped to [0, 100], NULL kept."""
    return clip((col_(c) / F.lit(float(reference))) * F.lit(100.0), 0.0, 100.0)


def nonnull_count(cols: Iterable[str | Column]) -> Column:
    """Number of non-null values in a row."""
    parts = [col_(c).isNotNull().cast("int") for c in cols]
    return _sum_left(parts) if parts else F.lit(0)


def row_mean(cols: Sequence[str | Column], null_as: float | None = 0.0) -> Column:
    """A10: mean across columns skipping NULL; all-null row -> ``null_as``.

    Sum is accumulated left to right, as pandas does for a row.
    """
    cols = [col_(c) for c in cols]
    total = _sum_left([F.coalesce(c, F.lit(0.0)) for c in cols])
    n = nonnull_count(cols)
    mean = total / F.when(n > 0, n.cast("double"))
    return mean if null_as is None else F.coalesce(mean, F.lit(float(null_as)))


def _sum_left(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def grade(score: str | Column, cutpoints: Sequence[tuple[str, float]], lowest: str) -> Column:
    """left-closed bins.  ``cutpoints`` is ``[(label, lower_edge), ...]``
    from the highest edge down; below the last edge -> ``lowest``; NULL -> ``lowest``."""
    s = col_(score)
    expr = None
    for label, edge in sorted(cutpoints, key=lambda t: -t[1]):
        cond = s >= F.lit(float(edge))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(lowest)) if expr is not None else F.lit(lowest)


def half_even_int(c: str | Column) -> Column:
    """Python ``int(round(x))``: banker's rounding to a whole number."""
    return F.bround(col_(c), 0).cast("long")


def isclose(a: str | Column, b: str | Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Numpy ``isclose`` (asymmetric: tolerance scales with ``b``)."""
    a, b = col_(a), col_(b)
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def format_number(c: str | Column, decimals: int = 1, suffix: str = "", missing: str = "—") -> Column:
    """Fixed decimals plus suffix, a dash for NULL."""
    c = col_(c)
    # format_string renders NULL as text, so test for NULL explicitly
    return F.when(c.isNull(), F.lit(missing)).otherwise(F.format_string(f"%.{int(decimals)}f{suffix}", c.cast("double")))


def tokens(q: str | Column) -> Column:
    """lower-cased whitespace tokens, empties dropped."""
    return F.filter(F.split(F.lower(col_(q)), r"\s+"), lambda x: x != "")


def humanise(c: str | Column, strip_suffix: str = "") -> Column:
    """F16: strip a suffix, underscores to spaces, title case."""
    c = col_(c)
    if strip_suffix:
        c = F.regexp_replace(c, strip_suffix + "$", "")
    return F.initcap(F.regexp_replace(c, "_", " "))


def option_label(text: str | Column, key: str | Column) -> Column:
    """``"{text} ({id})"``."""
    return F.format_string("%s (%d)", col_(text), col_(key).cast("long"))


def parse_id(c: str | Column, pattern: str = r"\((\d+)\)\s*$") -> Column:
    """numeric id from a label such as ``"Apple (123)"``; NULL when absent."""
    got = F.regexp_extract(col_(c), pattern, 1)
    return F.when(got != "", got.try_cast("long"))


def sanitize(c: str | Column) -> Column:
    """NULL -> '', trimmed."""
    return F.trim(F.coalesce(col_(c).cast("string"), F.lit("")))


def r6(c: str | Column) -> Column:
    """Round a float output to 6 decimals (driver comparison rule)."""
    return F.round(col_(c), 6)
