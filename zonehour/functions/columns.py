"""Column builders.

Each returns a ``Column`` made only of built-in expressions, so it stays
inside whole-stage codegen; none of them runs Python per row. Raw input goes
through ``try_*`` forms because ANSI mode is on in Spark 4: a malformed value
becomes null and a filter removes it, instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c: ColumnOrName) -> Column:
    """P5: ``lower(trim(c))``; null stays null."""
    return F.lower(F.trim(_col(c)))


def threshold_flag(c: ColumnOrName, bound: float, inclusive: bool = True) -> Column:
    """1 when ``c >= bound`` (or ``>`` if not inclusive), else 0 (null -> 0)."""
    cond = _col(c) >= F.lit(bound) if inclusive else _col(c) > F.lit(bound)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def scaled(c: ColumnOrName, missing: int, scale: float) -> Column:
    """Sentinel -> null, otherwise ``c / scale`` as double."""
    c = _col(c)
    return F.when(c != F.lit(missing), c / F.lit(float(scale)))


def precipitation(c: ColumnOrName, missing: int, trace: int, trace_mm: float, scale: float) -> Column:
    """Sentinel -> null, trace code -> ``trace_mm``, otherwise ``c / scale``."""
    c = _col(c)
    return (
        F.when(c == F.lit(missing), F.lit(None).cast("double"))
        .when(c == F.lit(trace), F.lit(float(trace_mm)))
        .otherwise(c / F.lit(float(scale)))
    )


def rain_flag(c: ColumnOrName) -> Column:
    """P10: 1 when precipitation > 0; null precipitation counts as no rain."""
    return F.when(_col(c) > F.lit(0.0), F.lit(1)).otherwise(F.lit(0))


def utc_timestamp(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName, hour: ColumnOrName) -> Column:
    """Wall-clock UTC hour as TIMESTAMP_NTZ; an impossible date gives null."""
    return F.try_make_timestamp_ntz(
        _col(year), _col(month), _col(day), _col(hour), F.lit(0), F.lit(0)
    )


def to_local(ts_utc: ColumnOrName, zone: str) -> Column:
    """UTC wall clock -> wall clock in ``zone`` (NTZ in, NTZ out).

    Independent of the session time zone, unlike ``from_utc_timestamp`` on a
    zoned timestamp.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts_utc))


def local_date(ts: ColumnOrName) -> Column:
    return F.to_date(_col(ts))


def local_hour(ts: ColumnOrName) -> Column:
    return F.hour(_col(ts))


def day_of_week(c: ColumnOrName) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(c))


def weekend_flag(dow: ColumnOrName) -> Column:
    """1 for Sunday (1) and Saturday (7)."""
    return F.when(_col(dow).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def ts_lower_bound(day: str) -> Column:
    """Start of ``day`` as a TIMESTAMP_NTZ literal (folded at plan time)."""
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def in_date_window(ts: ColumnOrName, lo: str, hi_exclusive: str) -> Column:
    """``to_date(ts) BETWEEN lo AND hi`` written as a half-open range on the
    timestamp itself, so it reaches the parquet reader as a pushed filter."""
    ts = _col(ts)
    return (ts >= ts_lower_bound(lo)) & (ts < ts_lower_bound(hi_exclusive))
