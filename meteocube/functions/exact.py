"""Exact means of readings, rounded once.

A double ``round(avg(x), 2)`` depends on summation order, so two engines (or two partitionings) can
disagree on halves.  Here a reading is the decimal number that its shortest text spells (to 12
places; from 2^53 on the whole number that it is), sums are exact, and only the finished mean is rounded: to 2 places, halves away from zero.

Two exact accumulators share the work.  A reading with at most 2 decimals and below 1e9 is added as a
long of hundredths, which costs no more than adding doubles; every other reading is added as a
DECIMAL(38, 12).  Both are plain sums, so Spark still aggregates before the shuffle.  The decimal of such a
reading is computed inside a one-element array: that keeps its code out of the generated methods of the scan and the
aggregate, which stay small enough for the JVM to compile.  Expressions are SQL text because a call to the JVM for every
operator made planning take seconds.

NaN and infinities are missing values.  A finite reading of ``LARGEST`` or more fails the query with a
message that names it: nothing is dropped or set to NULL silently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST = 1e21
_HUNDREDTHS_BELOW = 1e9
_WHOLE, _PART = 2**53, 2**40
_DEC, _SUM = "decimal(38,12)", "decimal(35,12)"


def finite(c: str) -> Column:
    """The reading, NULL when it is not a finite number."""
    return F.expr(f"CASE WHEN NOT isnan(`{c}`) AND abs(`{c}`) < double('infinity') THEN `{c}` END")


def _short(v: str) -> str:
    """Whether a reading is a number of hundredths below the bound."""
    return f"(abs({v}) < {_HUNDREDTHS_BELOW}D AND rint({v} * 100) / 100.0D = {v})"


def _let(value: str, name: str, use: str) -> str:
    """``use`` with ``name`` standing for the value, computed once."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


#: A finite reading x as DECIMAL(38, 12). From 2^53 on a double is a whole number, and its text may round it: taken exactly, in two parts.
_DECIMAL = f"""CASE
  WHEN abs(x) >= {LARGEST}D THEN cast(raise_error(concat('reading too large for exact sums: ', cast(x AS string))) AS {_DEC})
  WHEN abs(x) >= {_WHOLE}D THEN cast(cast(floor(x / {_PART}D) AS decimal(12,0)) * cast({_PART} AS decimal(13,0))
                                   + cast(cast(x - floor(x / {_PART}D) * {_PART}D AS bigint) AS decimal(13,0)) AS {_DEC})
  ELSE cast(x AS {_DEC}) END"""


def parts(value: str, prefix: str) -> list[Column]:
    """Columns ``{prefix}_c`` (hundredths as long) and ``{prefix}_d`` (decimal): one of them holds the finite ``value``."""
    v = f"`{value}`"
    return [F.expr(f"CASE WHEN {_short(v)} THEN cast(rint({v} * 100) AS bigint) END").alias(f"{prefix}_c"),
            F.expr(f"CASE WHEN {v} IS NOT NULL AND NOT {_short(v)} THEN {_let(v, 'x', _DECIMAL)} END").alias(f"{prefix}_d")]


def buffers(prefix: str) -> list[Column]:
    """Aggregates over ``parts``: the two sums and the number of readings."""
    c, d = f"`{prefix}_c`", f"`{prefix}_d`"
    # Without the filter every reading, most of which have no decimal, would rewrite the decimal buffer.
    return [F.expr(f"sum({c})").alias(f"{prefix}_sc"), F.expr(f"sum({d}) FILTER (WHERE {d} IS NOT NULL)").alias(f"{prefix}_sd"),
            F.expr(f"count(CASE WHEN {c} IS NOT NULL OR {d} IS NOT NULL THEN 1 END)").alias(f"{prefix}_n"), F.expr(f"count({d})").alias(f"{prefix}_nd")]


def merged(prefix: str) -> list[Column]:
    """Aggregates over ``buffers`` of smaller groups: the buffers of the larger ones."""
    sc, sd, n, nd = (f"`{prefix}_{x}`" for x in ("sc", "sd", "n", "nd"))
    return [F.expr(f"sum({sc})").alias(f"{prefix}_sc"), F.expr(f"sum({sd}) FILTER (WHERE {sd} IS NOT NULL)").alias(f"{prefix}_sd"),
            F.expr(f"sum({n})").alias(f"{prefix}_n"), F.expr(f"sum({nd})").alias(f"{prefix}_nd")]


# The quotient of two decimals is itself rounded (to its last place), so the hundredths it gives are checked against the
# exact remainder and corrected by one. s is (sc, sd, n); t the exact total, k the count, near the hundredths.
_CORRECTED = f"""CASE
  WHEN abs(t) - cast(near * k AS {_SUM}) >= k * cast(0.005 AS decimal(4,3)) THEN near + cast(0.01 AS decimal(3,2))
  WHEN abs(t) - cast(near * k AS {_SUM}) < -(k * cast(0.005 AS decimal(4,3))) THEN near - cast(0.01 AS decimal(3,2))
  ELSE near END"""
_MEAN = _let("cast(s.n AS decimal(11,0))", "k", f"sign(t) * cast({_let('cast(round(abs(t) / k, 2) AS decimal(23,2))', 'near', _CORRECTED)} AS double)")
# Without ANSI mode an overflowing decimal sum is NULL; it must not pass for "no such readings".
_TOTAL = f"""cast(cast(cast(coalesce(s.sc, 0L) AS decimal(20,0)) * cast(0.01 AS decimal(3,2)) AS {_SUM})
  + cast(coalesce(s.sd, cast(raise_error('sum of readings too large') AS {_DEC})) AS {_SUM}) AS {_SUM})"""


def mean(prefix: str) -> Column:
    """The exact mean over ``buffers``, rounded to 2 places, halves away from zero, as a double; NULL without readings."""
    sc, sd, n, nd = (f"`{prefix}_{x}`" for x in ("sc", "sd", "n", "nd"))
    whole = f"(2 * abs({sc}) + {n}) div (2 * {n})"
    exact = _let(f"named_struct('sc', {sc}, 'sd', {sd}, 'n', {n})", "s", _let(_TOTAL, "t", _MEAN))
    return F.expr(f"CASE WHEN {nd} > 0 THEN {exact} WHEN {n} > 0 THEN CASE WHEN {sc} < 0 THEN -({whole}) ELSE {whole} END / 100.0D END")


def rounded(c: str) -> Column:
    """A reading to 2 places, halves away from zero, as its decimal text reads."""
    # Most readings have two places already; rounding a double goes through its decimal text.
    return F.expr(f"CASE WHEN {_short(f'`{c}`')} THEN `{c}` ELSE round(`{c}`, 2) END")
