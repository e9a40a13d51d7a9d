"""Profiling aggregates (A6-A12, O1, O2, F5) and the two profile jobs.

The reference runs one job per column; here each profile is one aggregate
over all requested columns, so the input is scanned once per profile.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from zonehour.config import TripSpec, WeatherSpec
from zonehour.operators.positions import dense_positions
from zonehour.operators.weather import decode_weather, parse_weather
from zonehour.session import scratch_path
from zonehour.sources.readers import require_columns
from zonehour.sources.sinks import sample_rows, write_table

# --- fixed values: output names of the trip profile -------------------------
TRIP_NULL_COUNT_NAMES = (
    ("tpep_pickup_datetime", "null_pickup_ts"),
    ("PULocationID", "null_pu_location"),
    ("DOLocationID", "null_do_location"),
    ("trip_distance", "null_trip_distance"),
    ("fare_amount", "null_fare_amount"),
    ("total_amount", "null_total_amount"),
)
TRIP_RANGE_COLUMNS = ("trip_distance", "fare_amount", "total_amount")
TRIP_DISTINCT_COLUMNS = ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")
WEATHER_STAT_COLUMNS = ("air_temp_c", "wind_speed_mps", "precipitation_1hr_mm")
TRIP_SAMPLE_COLUMNS = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "payment_type",
    "fare_amount",
    "total_amount",
)
# fields of TripSpec that the trip profile reads
TRIP_PROFILE_FIELDS = ("pickup_ts", "pickup_zone", "dropoff_zone", "passengers", "distance", "rate_code", "payment", "store_flag", "fare", "total", "vendor")
SAMPLE_ROWS = 20
MODE_TOP_N = 10
# --- end of fixed values -----------------------------------------------------

# layout of a double, for value_image; bits that a level of the median's selection tells apart
LEAST_EXPONENT, GREATEST_EXPONENT, MANTISSA_BITS, IMAGE_BITS = -1022, 1023, 52, 64
RADIX_BITS = 12
STATS_SCHEMA = "column_name string, non_null_count bigint, mean_value double, median_value double, stddev_value double, min_value double, max_value double"


def null_count_aggs(columns: Mapping[str, str] | Sequence[str]) -> list[Column]:
    named = dict(columns) if isinstance(columns, Mapping) else {c: f"null_{c}" for c in columns}
    return [F.sum(F.when(F.col(c).isNull(), F.lit(1)).otherwise(F.lit(0))).alias(out) for c, out in named.items()]


def range_aggs(columns: Sequence[str]) -> list[Column]:
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.avg(c).alias(f"avg_{c}")]
    return aggs


def null_counts(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """One row, one null count per column (``null_<col>`` unless named)."""
    return df.agg(*null_count_aggs(columns))


def numeric_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max and mean of each column, one row."""
    return df.agg(*range_aggs(columns))


def overview(
    df: DataFrame,
    null_columns: Mapping[str, str] | Sequence[str],
    range_columns: Sequence[str],
    count_name: str = "record_count",
) -> DataFrame:
    """A6 + A7 + A9 in one pass: row count, null counts and ranges, one row.
    A profile of a 100 TB table then costs one scan instead of three."""
    return df.agg(F.count(F.lit(1)).alias(count_name), *null_count_aggs(null_columns), *range_aggs(range_columns))


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, value, count of the non-null values of every column, as
    doubles; counted in each task before the shuffle, in one scan."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column_name", "value")
    return long.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def value_image(value: Column) -> Column:
    """A bigint that orders as the double does: its exponent and mantissa,
    negated for a negative value. Both zeros are 0; NaN comes last.

    Every step is exact: the logarithm only guesses the exponent, a quotient
    by a power of two keeps the mantissa, and a guess that is one off moves
    the mantissa into the range next to it.
    """
    size, one = F.abs(value), 1 << MANTISSA_BITS
    guess = F.least(F.lit(GREATEST_EXPONENT), F.greatest(F.lit(LEAST_EXPONENT), F.floor(F.log2(size))))
    part = size / F.pow(F.lit(2.0), guess.cast("double"))
    off = F.when(part >= 2, F.lit(1)).when((part < 1) & (guess > LEAST_EXPONENT), F.lit(-1)).otherwise(F.lit(0))
    mantissa = F.when(part >= 2, part / 2).when((part < 1) & (guess > LEAST_EXPONENT), part * 2).otherwise(part)
    finite = (guess + off - LEAST_EXPONENT) * F.lit(one) + (mantissa * F.lit(float(one))).cast("long")
    beyond = (GREATEST_EXPONENT - LEAST_EXPONENT + 2) * one
    image = F.when(F.isnan(value), F.lit(beyond + 1)).when(size == math.inf, F.lit(beyond)).when(size > 0, finite).otherwise(F.lit(0))
    return F.when(value < 0, -image).otherwise(image).cast("long")


def count_ranges(histogram: DataFrame, shift: int) -> dict[str, list[Row]]:
    """Per column the ranges of values whose images agree down to bit
    ``shift``, in order: n, total, least and greatest value."""
    n, x = F.col("count"), F.col("value")
    counted = histogram.groupBy("column_name", F.shiftright("image", shift).alias("digit")).agg(
        F.sum(n).alias("n"), F.sum(n * x).alias("total"), F.min(x).alias("lo"), F.max(x).alias("hi")
    )
    out: dict[str, list[Row]] = {}
    for r in sorted(counted.collect(), key=lambda r: r.digit):
        out.setdefault(r.column_name, []).append(r)
    return out


def ranked_values(histogram: DataFrame, ranges: dict[str, list[Row]], ranks: Mapping[str, int]) -> dict[str, float]:
    """The value at a rank (from 1) of each column, by radix selection: the
    range that holds the rank is counted by the next RADIX_BITS of the image,
    until it holds one value. ``ranges`` are the top level's."""
    found, rest, shift = {}, dict(ranks), IMAGE_BITS - RADIX_BITS
    while rest:
        inside = F.lit(False)
        for c in list(rest):
            for r in ranges[c]:
                if rest[c] <= r.n:
                    break
                rest[c] -= r.n
            if r.lo == r.hi or shift == 0:
                found[c] = r.lo
                del rest[c]
            else:
                inside = inside | (F.col("column_name") == c) & (F.shiftright("image", shift) == r.digit)
        if rest:
            histogram, shift = histogram.where(inside), max(0, shift - RADIX_BITS)
            ranges = count_ranges(histogram, shift)
    return found


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A8 + F5: per column the non-null count, mean, median (the least value
    with half of the values up to it), sample standard deviation, min and
    max; one row per column, nulls and zero for a column without values.
    ``df`` is read once, here, for a histogram in the shared scratch folder."""
    return histogram_stats(stored_histogram(df, columns), columns)


def stored_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``value_histogram`` with each value's ``image``, written to the shared
    scratch folder."""
    path = scratch_path(df.sparkSession, "histogram")
    histogram = value_histogram(df, columns).withColumn("image", value_image(F.col("value")))
    write_table(histogram, path)
    return df.sparkSession.read.schema(histogram.schema).parquet(path)


def histogram_stats(histogram: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A8 from a ``stored_histogram``; see ``numeric_stats``.

    The median is exact (``ranked_values``). A level of the selection has at
    most 2**RADIX_BITS ranges per column whatever the values, and these come
    to the driver, as does the row of each column; no task orders a column,
    however its values are spread.
    """
    ranges = count_ranges(histogram.where(F.col("column_name").isin(list(columns))), IMAGE_BITS - RADIX_BITS)
    n = {c: sum(r.n for r in found) for c, found in ranges.items()}
    mean = {c: sum(r.total for r in found) / n[c] for c, found in ranges.items()}
    median = ranked_values(histogram, ranges, {c: -(-k // 2) for c, k in n.items()})

    apart = F.col("value") - F.create_map(*[F.lit(x) for pair in mean.items() for x in pair])[F.col("column_name")] if mean else F.lit(0.0)
    squares = {r.column_name: r.squares for r in histogram.groupBy("column_name").agg(F.sum(F.col("count") * apart * apart).alias("squares")).collect()}
    rows = []
    for c in columns:
        found = ranges.get(c)
        spread = math.sqrt(squares[c] / (n[c] - 1)) if found and n[c] > 1 else None
        rows.append((c, n.get(c, 0), mean.get(c), median.get(c), spread, found and found[0].lo, found and found[-1].hi))
    return histogram.sparkSession.createDataFrame(rows, STATS_SCHEMA)


def distinct_values(
    df: DataFrame,
    column: str,
    exclude: Sequence | None = None,
    n: int | None = None,
    drop_nulls: bool = True,
) -> DataFrame:
    """A11 + O1 + F5: sorted distinct values of one column, optionally
    without nulls and listed sentinel values. ``n`` keeps only the first n
    (the printed preview); the default returns the whole list."""
    c = F.col(column)
    out = df.select(c)
    if drop_nulls:
        out = out.where(c.isNotNull())
    if exclude:
        out = out.where(~c.isin(list(exclude)))
    out = out.distinct().orderBy(c.asc_nulls_first())
    return out.limit(n) if n else out


def distinct_lists(
    df: DataFrame,
    columns: Sequence[str],
    exclude: Mapping[str, Sequence] | None = None,
    n: int | None = None,
    positions: bool = False,
) -> DataFrame:
    """A11 + O1 over several columns in one scan: (column_name, value) with
    ``value`` as text and each column ordered by its own type (numbers
    numerically, text as text). Nulls and the ``exclude`` values of a column
    are left out.

    With ``n``, the first n values per column and their ``position`` (from 1)
    come from ``row_number()``, planned with a partial group limit before the
    shuffle. Without ``n`` the whole list is a distributed sort; no column's
    values are gathered into one window partition. ``positions`` then numbers
    the whole lists, from counts per sorted range (``dense_positions``; the
    list is written to the shared scratch folder here).
    """
    exclude = exclude or {}
    types = dict(df.dtypes)
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    items = []
    for c in columns:
        x = F.col(c)
        keep = x.isNotNull()
        if exclude.get(c):
            keep = keep & ~x.isin(list(exclude[c]))
        sort_key = x.cast("double") if types[c] in numeric or types[c].startswith("decimal") else F.lit(None).cast("double")
        item = F.struct(x.cast("string").alias("value"), sort_key.alias("sort_key"))
        items.append(F.when(keep, item).alias(c))
    long = df.select(*items).unpivot([], list(columns), "column_name", "item")
    distinct = long.where(F.col("item").isNotNull()).select(
        "column_name", F.col("item.value").alias("value"), F.col("item.sort_key").alias("sort_key")
    ).distinct()
    order = [F.col("sort_key").asc_nulls_last(), F.col("value").asc()]
    if n:
        w = Window.partitionBy("column_name").orderBy(*order)
        ranked = distinct.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)
        return ranked.select("column_name", "value", "position")
    if positions:
        numbered = dense_positions(distinct, [F.col("column_name"), *order], within=["column_name"])
        return numbered.select("column_name", "value", (F.col("position") + 1).alias("position"))
    return distinct.orderBy(F.col("column_name"), *order).select("column_name", "value")


def value_counts(df: DataFrame, column: str, n: int = MODE_TOP_N) -> DataFrame:
    """A12 + O2: the n most frequent non-null values of one column, ties by
    value ascending (TakeOrderedAndProject: per-task top n, then a merge)."""
    c = F.col(column)
    return df.where(c.isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c.asc()).limit(n)


def mode_top(df: DataFrame, columns: Sequence[str], n: int = MODE_TOP_N) -> DataFrame:
    """A12 over several columns in one scan: (column_name, value, count, rank).

    Values are counted per (column, value) with map-side partial aggregation;
    the per-column top n uses ``row_number() <= n``, which Spark plans with a
    partial group limit before the shuffle, so each task ships at most n rows
    per column to the final ranking.
    """
    return histogram_modes(value_histogram(df, columns), n)


def histogram_modes(histogram: DataFrame, n: int = MODE_TOP_N) -> DataFrame:
    """A12 from a ``value_histogram`` or a stored one; see ``mode_top``."""
    w = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    ranked = histogram.withColumn("rank", F.row_number().over(w))
    return ranked.where(F.col("rank") <= n).select("column_name", "value", "count", "rank")


def keyed_count(df: DataFrame, key: str = "record_count") -> DataFrame:
    """A10: count by a constant key, (metric, value)."""
    return df.groupBy(F.lit(key).alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def schema_report(df: DataFrame) -> DataFrame:
    """The schema as rows: (position, column_name, data_type), as a profile
    prints it. Reads no data."""
    rows = [(k, f.name, f.dataType.simpleString()) for k, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def stage_counts(inputs: Sequence[tuple[DataFrame, Mapping[str, Column | None]]]) -> DataFrame:
    """(stage, rows). Each input is read once: a stage counts its rows
    that meet the condition, all rows for None."""
    out = None
    for df, stages in inputs:
        one = F.lit(1)
        counts = df.agg(*[F.count(one if c is None else F.when(c, one)).alias(name) for name, c in stages.items()])
        rows = counts.unpivot([], list(stages), "stage", "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def standard_trip_columns(raw: DataFrame, spec: TripSpec) -> DataFrame:
    """The profiled columns of ``raw`` under their usual names; an error names
    those that are missing."""
    usual = TripSpec()
    own = {getattr(usual, f): getattr(spec, f) for f in TRIP_PROFILE_FIELDS}
    require_columns(raw, tuple(own.values()), "trips")
    return raw.select(*[F.col(c).alias(name) for name, c in own.items()])


def profile_trips(raw: DataFrame, spec: TripSpec = TripSpec(), preview_n: int | None = None) -> dict[str, DataFrame]:
    """The trip profile: the schema, the overview and the distinct lists
    (lazy, two scans of the raw table) and a 20-row sample, taken here. The
    lists are whole unless ``preview_n`` cuts them."""
    trips = standard_trip_columns(raw, spec)
    return {
        "schema": schema_report(raw),
        "overview": overview(trips, dict(TRIP_NULL_COUNT_NAMES), TRIP_RANGE_COLUMNS),
        "distinct_values": distinct_lists(trips, list(TRIP_DISTINCT_COLUMNS), n=preview_n),
        "sample": sample_rows(trips.select(*TRIP_SAMPLE_COLUMNS), SAMPLE_ROWS),
    }


def profile_weather(lines: DataFrame, spec: WeatherSpec = WeatherSpec(), preview_n: int | None = None) -> dict[str, DataFrame]:
    """The weather profile over parsed, decoded (not windowed) lines. The
    lists are whole unless ``preview_n`` cuts them. The lines are parsed once:
    the records go to the shared scratch folder here, and every profile reads
    its columns of them."""
    decoded = decode_weather(parse_weather(lines, spec), spec).drop("source_path_normalized")
    path = scratch_path(lines.sparkSession, "weather-parsed")
    write_table(decoded, path)
    parsed = lines.sparkSession.read.schema(decoded.schema).parquet(path)
    histogram = stored_histogram(parsed, WEATHER_STAT_COLUMNS)
    return {
        "schema": schema_report(parsed),
        "line_count": keyed_count(lines, "raw_line_count"),
        "distinct_values": distinct_lists(
            parsed,
            ["station_id", "wind_direction_degrees", "sky_cover_code"],
            exclude={"wind_direction_degrees": [spec.missing], "sky_cover_code": [spec.missing]},
            n=preview_n,
        ),
        "numeric_stats": histogram_stats(histogram, WEATHER_STAT_COLUMNS),
        "mode_top10": histogram_modes(histogram, MODE_TOP_N),
        "sample": sample_rows(parsed, SAMPLE_ROWS),
    }
