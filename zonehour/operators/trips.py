"""Raw trips -> typed, validated, windowed trip table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonehour.config import TripSpec, day_after
from zonehour.functions.columns import day_of_week, in_date_window, normalize_text, threshold_flag

# --- fixed values: column order of the clean trip table ---
TRIPS_CLEAN_COLUMNS = (
    "pickup_date",
    "pickup_hour",
    "pickup_day_of_week",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "payment_type",
    "store_and_fwd_flag_normalized",
    "fare_amount",
    "total_amount",
    "is_long_trip",
    "is_high_fare",
)


def typed_trips(raw: DataFrame, spec: TripSpec = TripSpec(), carry: tuple[str, ...] = ()) -> DataFrame:
    """The ten analytic columns, renamed and cast. Integer casts truncate
    (1.9 -> 1); a value that cannot be cast becomes null. ``carry`` names
    extra input columns passed through unchanged (e.g. a record id)."""
    return raw.select(
        F.col(spec.pickup_ts).try_cast("timestamp_ntz").alias("pickup_ts"),
        F.col(spec.pickup_zone).try_cast("int").alias("PULocationID"),
        F.col(spec.dropoff_zone).try_cast("int").alias("DOLocationID"),
        F.col(spec.passengers).try_cast("int").alias("passenger_count"),
        F.col(spec.distance).try_cast("double").alias("trip_distance"),
        F.col(spec.rate_code).try_cast("int").alias("RatecodeID"),
        F.col(spec.payment).try_cast("int").alias("payment_type"),
        normalize_text(spec.store_flag).alias("store_and_fwd_flag_normalized"),
        F.col(spec.fare).try_cast("double").alias("fare_amount"),
        F.col(spec.total).try_cast("double").alias("total_amount"),
        *carry,
    )


def trip_rules() -> dict[str, Column]:
    """the validity rules, by name. Rate code, payment type and the flag
    are not checked and may stay null. Zero passengers are valid."""
    # a comparison with null keeps no row, so nulls need no test of their own
    return {
        "pickup_present": F.col("pickup_ts").isNotNull(),
        **{f"{c} positive": F.col(c) > 0 for c in ("PULocationID", "DOLocationID", "trip_distance")},
        **{f"{c} not negative": F.col(c) >= 0 for c in ("passenger_count", "fare_amount", "total_amount")},
    }


def valid_trips(typed: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """F1 as one conjunctive filter."""
    cond = _conjunction(list((rules or trip_rules()).values()))
    return typed if cond is None else typed.where(cond)


def _conjunction(conds: list[Column]) -> Column | None:
    out = None
    for c in conds:
        out = c if out is None else out & c
    return out


def window_condition(ts_col: str, window: tuple[str, str] | None) -> Column | None:
    """F2/F4 as a column: the date of ``ts_col`` lies in the inclusive window,
    written as a half-open timestamp range so the parquet scan receives it."""
    if window is None:
        return None
    lo, hi = window
    return in_date_window(ts_col, lo, day_after(hi))


def date_window(df: DataFrame, ts_col: str, window: tuple[str, str] | None) -> DataFrame:
    """keep rows whose date of ``ts_col`` lies in the inclusive window."""
    cond = window_condition(ts_col, window)
    return df if cond is None else df.where(cond)


def with_calendar(df: DataFrame, ts_col: str, prefix: str) -> DataFrame:
    """``<prefix>_date``, ``<prefix>_hour`` and ``<prefix>_day_of_week``
    (1 = Sunday) of a wall-clock timestamp column, in one projection."""
    ts = F.col(ts_col)
    return df.withColumns(
        {f"{prefix}_date": F.to_date(ts), f"{prefix}_hour": F.hour(ts), f"{prefix}_day_of_week": day_of_week(ts)}
    )


def valid_trip_condition(spec: TripSpec = TripSpec()) -> Column:
    """F1 + F2 as one condition over ``typed_trips``."""
    window = window_condition("pickup_ts", spec.window)
    return _conjunction(list(trip_rules().values()) + ([window] if window is not None else []))


def clean_trips(raw: DataFrame, spec: TripSpec = TripSpec(), carry: tuple[str, ...] = ()) -> DataFrame:
    """C3. Narrow transformation only (project + filter): no shuffle, one
    pass, and the window and non-null tests reach the parquet reader."""
    typed = typed_trips(raw, spec, carry)
    kept = typed.where(valid_trip_condition(spec))
    flags = {
        "is_long_trip": threshold_flag("trip_distance", spec.long_trip_miles),
        "is_high_fare": threshold_flag("fare_amount", spec.high_fare_amount),
    }
    return with_calendar(kept, "pickup_ts", "pickup").withColumns(flags).select(*TRIPS_CLEAN_COLUMNS, *carry)
