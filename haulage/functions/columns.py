"""Reusable Column expressions.

Everything here returns a ``pyspark.sql.Column`` made of built-in functions,
so it stays inside whole-stage code generation; there is no Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulage.rules import DEFAULT_RULES, Rules


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(
    value,
    steps: Sequence[tuple[str, float]],
    over_label: str,
    null_label: str | None = None,
) -> Column:
    """Label ``value`` by the first step whose upper bound (inclusive) it meets.

    ``steps`` is ``[(label, upper), ...]`` in increasing order.  Values above
    the last bound get ``over_label``.  NULL gets ``null_label`` when given,
    otherwise it falls through to ``over_label`` (a plain ``otherwise``).
    """
    v = _col(value)
    expr = None
    if null_label is not None:
        expr = F.when(v.isNull(), F.lit(null_label))
    for label, upper in steps:
        cond = v <= F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(over_label)
    return expr.otherwise(F.lit(over_label))


def bucketize_desc(value, bands: Sequence[tuple[str, float]], else_label: str) -> Column:
    """Label by the first band whose lower bound (exclusive) ``value`` exceeds."""
    v = _col(value)
    expr = None
    for label, lower in bands:
        cond = v > F.lit(lower)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(else_label) if expr is None else expr.otherwise(F.lit(else_label))


def count_where(predicate: Column) -> Column:
    """Conditional count (NULL predicate counts as false); bigint."""
    return F.count_if(F.coalesce(predicate, F.lit(False)))


def pct(num, den, digits: int = 1) -> Column:
    """Percentage ``num / den * 100`` rounded to ``digits`` (HALF_UP)."""
    return F.round(F.try_divide(_col(num), _col(den)) * F.lit(100), digits)


def month_label(year, month) -> Column:
    """``YYYY-MM`` text from integer year and month."""
    return F.concat_ws(
        "-", _col(year).cast("string"), F.lpad(_col(month).cast("string"), 2, "0")
    )


def out_of_bounds(lat="lat", lng="lng", rules: Rules = DEFAULT_RULES) -> Column:
    """True when a known coordinate lies outside the bounds.

    Three-valued like SQL: a NULL coordinate contributes NULL, so a row with
    both coordinates NULL yields NULL (callers decide how NULL counts).
    """
    la, ln = _col(lat), _col(lng)
    return (
        (la < F.lit(rules.lat_min))
        | (la > F.lit(rules.lat_max))
        | (ln < F.lit(rules.lng_min))
        | (ln > F.lit(rules.lng_max))
    )


def in_bounds(lat="lat", lng="lng", rules: Rules = DEFAULT_RULES) -> Column:
    """True when both coordinates are known and inside the bounds."""
    la, ln = _col(lat), _col(lng)
    return (
        (la >= F.lit(rules.lat_min))
        & (la <= F.lit(rules.lat_max))
        & (ln >= F.lit(rules.lng_min))
        & (ln <= F.lit(rules.lng_max))
    )


def thousands(value) -> Column:
    """Integer text with thousands separators: 99515 -> '99,515'."""
    return F.format_number(_col(value).cast("double"), 0)


def parse_timestamp(value, formats: Sequence[str], lenient: bool = False) -> Column:
    """Parse text to timestamp with the first matching format; bad text -> NULL.

    ``try_to_timestamp`` never raises, so malformed values (date-only text,
    junk, empty strings) become NULL under ANSI mode too.
    """
    v = _col(value)
    if lenient:  # blanks around the text and fractions of a second do not matter
        v = F.regexp_replace(F.trim(v), r"\.[0-9]+$", "")
    parsed = [F.try_to_timestamp(v, F.lit(fmt)) for fmt in formats]
    return parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row; a NULL is told from every value and from a NULL elsewhere."""
    cols = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[c.isNull().cast("int").cast("string") for c in cols]) if cols else F.lit("")
    return F.xxhash64(F.lit(1), nulls, *cols), F.xxhash64(F.lit(2), nulls, *reversed(cols))


def content_sums(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``n``, ``a``, ``b`` over rows that are equal for equal multisets of rows, whatever their order."""
    a, b = row_hashes(columns)
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(a.cast("decimal(38,0)")).cast("string").alias("a"),
        F.sum(b.cast("decimal(38,0)")).cast("string").alias("b"),
    ]
