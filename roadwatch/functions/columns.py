"""Scalar column expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's defaults.
OVERSPEED_FACTOR = 1.1        # fires when limit < 1.1 * measured speed
SEVERE_FACTOR = 1.2           # severe when limit * 1.2 <= measured speed
DEFAULT_LIMIT = 60            # limit assumed for a station missing from the table
LONG_MAX = 9223372036854775807
DAY_MS = 24 * 60 * 60 * 1000


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def millis_to_ts(c="action_time") -> Column:
    """Epoch milliseconds -> TIMESTAMP (session zone UTC), for windows and watermarks."""
    return F.timestamp_millis(col_(c))


def ts_to_millis(c) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> epoch milliseconds (NTZ read as UTC wall time)."""
    return F.unix_millis(col_(c).cast("timestamp"))


def overspeed(limit="limit_speed", speed="speed", factor: float = OVERSPEED_FACTOR) -> Column:
    """The factor multiplies the *measured* speed (fires from ~91 % of the limit)."""
    return col_(limit) < F.lit(float(factor)) * col_(speed)


def severe_overspeed(limit="limit_speed", speed="speed", factor: float = SEVERE_FACTOR) -> Column:
    """The factor multiplies the *limit* (opposite side of C1)."""
    return col_(limit) * F.lit(float(factor)) <= col_(speed)


def newest_first_key(car="car", action_time="action_time") -> Column:
    """``car + "_" + (Long.MAX - action_time)``; sorts a car's rows newest first."""
    return F.concat(col_(car), F.lit("_"),
                    (F.lit(LONG_MAX).cast("long") - col_(action_time)).cast("string"))


def day_start_ms(c="action_time") -> Column:
    """Start of the (session-zone) day containing epoch-ms ``c``, as epoch ms."""
    return ts_to_millis(F.date_trunc("DAY", millis_to_ts(c)))


def rounded_average(sum_col: str, n_col: str) -> Column:
    """round_half_up(sum / n, 2) as double, from an exact decimal sum and a count.

    ``sum_col`` holds ``sum(cast(x as decimal(18,4)))``. The average in cents is
    ``(2*S + 100*n) div (200*n)`` with ``S`` in 1e-4 units: exact integer
    arithmetic (``div`` on decimals is an exact integral quotient), so no
    half-cent tie is decided by float noise. The oracle evaluates the same
    formula. Valid for non-negative sums (speeds).
    """
    return F.expr(
        f"cast((2 * ({sum_col} * 10000) + 100 * {n_col}) div (200 * {n_col}) as double) / 100D")


def with_tie_id(df: DataFrame, id_col: str) -> DataFrame:
    """Make sure ``id_col`` exists as the tie-breaker among records of equal time.

    Records parsed from text logs carry no id; then a deterministic one is
    derived from the record's own fields (``xxhash64`` of every column), so
    ordering is total and repeatable (identical records tie, which changes no
    output).
    """
    if id_col in df.columns:
        return df
    return df.withColumn(id_col, F.xxhash64(*[F.col(c) for c in df.columns]))
