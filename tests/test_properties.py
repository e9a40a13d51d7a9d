"""Property tests: random raw inputs against a plain-Python model of the rules.

Each hypothesis example is a whole batch of rows, so one example costs one
Spark job.
"""

import math
import re
from collections import Counter
from datetime import date, datetime, timedelta
from statistics import mean, stdev
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from zonehour.config import WeatherSpec
from zonehour.operators.features import build_features, hourly_weather
from zonehour.operators.metrics import forecast_metrics
from zonehour.operators.profile import distinct_lists, mode_top, numeric_stats
from zonehour.operators.trips import clean_trips
from zonehour.operators.weather import clean_weather, parse_weather

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

# ---- weather ----------------------------------------------------------------

token = st.one_of(
    st.integers(-9999, 99999).map(str),
    st.sampled_from(["-9999", "-1", "0", "XX", "12a"]),
)
year = st.sampled_from(["2023", "2024"])
month = st.integers(1, 13).map(lambda m: f"{m:02d}")
day = st.integers(0, 32).map(lambda d: f"{d:02d}")
hour = st.integers(0, 24).map(lambda h: f"{h:02d}")


@st.composite
def weather_line(draw):
    head = [draw(year), draw(month), draw(day), draw(hour)]
    rest = draw(st.lists(token, min_size=5, max_size=10))
    toks = head + rest
    seps = [draw(st.sampled_from([" ", "  ", "   "])) for _ in toks]
    lead = draw(st.sampled_from(["", " ", "  "]))
    trail = draw(st.sampled_from(["", " "]))
    return lead + "".join(t + s for t, s in zip(toks, seps)).rstrip(" ") + trail


def _int(tok):
    return int(tok) if re.fullmatch(r"-?\d+", tok) and -(2**31) <= int(tok) < 2**31 else None


def model_parse(line):
    parts = re.split(r"\s+", line.strip(" "))
    if len(parts) < 12:
        return None
    return [_int(t) for t in parts[:12]]


def model_clean(fields, spec=WeatherSpec()):
    y, mo, d, h = fields[:4]
    try:
        utc = datetime(y, mo, d, h) if None not in (y, mo, d, h) else None
    except ValueError:
        utc = None
    if utc is None:
        return None
    local = utc.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(spec.local_zone)).replace(tzinfo=None)
    lo, hi = (date.fromisoformat(v) for v in spec.window)
    if not lo <= local.date() <= hi:
        return None

    def scaled(v):
        return None if v is None or v == spec.missing else v / spec.scale

    def precip(v):
        if v is None or v == spec.missing:
            return None
        return spec.trace_mm if v == spec.trace else v / spec.scale

    p1 = precip(fields[10])
    return (utc, local, local.date(), local.hour, scaled(fields[4]), scaled(fields[8]), p1, precip(fields[11]), 1 if (p1 or 0) > 0 else 0, fields[7], fields[9])


@settings(**SETTINGS)
@given(st.lists(weather_line(), min_size=40, max_size=40))
def test_weather_matches_python_model(spark, lines):
    df = spark.createDataFrame([(l, f"file:/w/744860-94789-2024/{i}.gz") for i, l in enumerate(lines)], "value string, source_path string")
    parsed = {r.source_path_normalized: r for r in parse_weather(df).collect()}
    cleaned = {r.source_path_normalized: r for r in clean_weather(df).collect()}
    for i, line in enumerate(lines):
        key = f"file:/w/744860-94789-2024/{i}.gz"
        fields = model_parse(line)
        if fields is None:
            assert key not in parsed
            continue
        got = parsed[key]
        assert [got[n] for n in WeatherSpec().fields] == fields, line
        want = model_clean(fields)
        if want is None:
            assert key not in cleaned, line
            continue
        r = cleaned[key]
        have = (r.observation_ts_utc, r.observation_ts_local, r.observation_date_local, r.observation_hour_local,
                r.air_temp_c, r.wind_speed_mps, r.precipitation_1hr_mm, r.precipitation_6hr_mm, r.is_rain_1hr,
                r.wind_direction_degrees, r.sky_cover_code)
        assert have == want, line


# ---- trips ------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

maybe = lambda s: st.one_of(st.none(), s)
ts = st.integers(-3 * 86400, 34 * 86400).map(lambda s: datetime(2024, 1, 1) + timedelta(seconds=s))
money = st.sampled_from([-0.01, 0.0, 0.01, 4.99, 5.0, 19.99, 20.0, 55.5])


@st.composite
def trip(draw):
    return (
        draw(maybe(ts)),
        draw(maybe(st.integers(-2, 300))),
        draw(maybe(st.integers(-2, 300))),
        draw(maybe(st.sampled_from([-1.5, -1.0, -0.5, 0.0, 0.5, 1.0, 1.9, 6.0]))),
        draw(maybe(st.sampled_from([-1.0, 0.0, 0.1, 4.99, 5.0, 12.3]))),
        draw(maybe(st.integers(1, 99))),
        draw(maybe(st.integers(0, 6))),
        draw(maybe(st.sampled_from([" Y ", "n", "N", "", "  "]))),
        draw(maybe(money)),
        draw(maybe(money)),
    )


def model_trip(t):
    pick, pu, do, pax, dist, rate, pay, flag, fare, total = t
    pax_i = None if pax is None else math.trunc(pax)
    ok = (
        pick is not None
        and pu is not None and pu > 0
        and do is not None and do > 0
        and pax_i is not None and pax_i >= 0
        and dist is not None and dist > 0
        and fare is not None and fare >= 0
        and total is not None and total >= 0
        and date(2024, 1, 1) <= pick.date() <= date(2024, 1, 31)
    )
    if not ok:
        return None
    return (pick.date(), pick.hour, pick.isoweekday() % 7 + 1, pu, do, pax_i, dist, rate, pay,
            None if flag is None else flag.strip(" ").lower(), fare, total, int(dist >= 5.0), int(fare >= 20.0))


@settings(**SETTINGS)
@given(st.lists(trip(), min_size=60, max_size=60))
def test_trips_match_python_model(spark, trips):
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(trips)], RAW_SCHEMA)
    got = {r.id: tuple(r)[:-1] for r in clean_trips(df, carry=("id",)).collect()}
    for i, t in enumerate(trips):
        want = model_trip(t)
        if want is None:
            assert i not in got, t
        else:
            assert got[i] == want, t


# ---- features and metrics ---------------------------------------------------

days = st.integers(1, 6).map(lambda d: date(2024, 1, d))
hours = st.integers(0, 3)


@st.composite
def weather_rows(draw):
    return (
        draw(st.sampled_from(["s1", "s2", "s3"])),
        draw(days),
        draw(hours),
        draw(maybe(st.integers(-50, 50).map(lambda v: v / 10))),
        draw(maybe(st.integers(0, 90).map(lambda v: v / 10))),
        draw(maybe(st.sampled_from([0.0, 0.1, 2.5]))),
    )


@st.composite
def demand_rows(draw):
    return (draw(days), draw(hours), draw(st.integers(1, 4)), draw(st.integers(1, 9)), 1.5, 12.0)


@settings(**SETTINGS)
@given(st.lists(weather_rows(), min_size=0, max_size=40), st.lists(demand_rows(), min_size=1, max_size=40, unique_by=lambda r: r[:3]))
def test_features_match_python_model(spark, weather, demand):
    wdf = spark.createDataFrame(
        [(s, d, h, t, w, p, 1 if (p or 0) > 0 else 0) for s, d, h, t, w, p in weather],
        "station_id string, observation_date_local date, observation_hour_local int, air_temp_c double, "
        "wind_speed_mps double, precipitation_1hr_mm double, is_rain_1hr int",
    )
    ddf = spark.createDataFrame(
        demand,
        "pickup_date date, pickup_hour int, PULocationID int, trip_count bigint, avg_trip_distance double, avg_fare_amount double",
    )
    got = {(r.pickup_date, r.pickup_hour, r.PULocationID): r for r in build_features(ddf, hourly_weather(wdf), weather_spec=WeatherSpec()).collect()}
    assert len(got) == len(demand)

    def mean(xs):
        xs = [x for x in xs if x is not None]
        return sum(xs) / len(xs) if xs else None

    for d, h, z, n, dist, fare in demand:
        obs = [w for w in weather if w[1] == d and w[2] == h]
        r = got[(d, h, z)]
        want_temp = mean([w[3] for w in obs]) or 0.0
        assert r.trip_count == n and r.avg_trip_distance == dist
        assert abs(r.avg_temp_c - want_temp) < 1e-9
        assert abs(r.avg_wind_speed_mps - (mean([w[4] for w in obs]) or 0.0)) < 1e-9
        assert abs(r.avg_precipitation_1hr_mm - (mean([w[5] for w in obs]) or 0.0)) < 1e-9
        assert r.is_rain_hour == max([1 if (w[5] or 0) > 0 else 0 for w in obs], default=0)
        assert r.station_count == len({w[0] for w in obs})
        dow = d.isoweekday() % 7 + 1
        assert r.day_of_week == dow and r.is_weekend == int(dow in (1, 7))


@settings(**SETTINGS)
@given(st.lists(st.tuples(maybe(st.integers(0, 20)), maybe(st.integers(-5, 25).map(float))), min_size=1, max_size=50))
def test_metrics_match_python_model(spark, pairs):
    usable = [(y, p) for y, p in pairs if y is not None and p is not None]
    df = spark.createDataFrame(pairs, "label bigint, prediction double")
    if not usable:
        with pytest.raises(Exception, match="at least one row with both"):
            forecast_metrics(df).collect()
        return
    (m,) = forecast_metrics(df).collect()
    n = len(usable)
    assert m.test_rows == n
    assert abs(m.mae - sum(abs(p - y) for y, p in usable) / n) < 1e-9
    assert abs(m.rmse - math.sqrt(sum((p - y) ** 2 for y, p in usable) / n)) < 1e-9
    pos = [(y, p) for y, p in usable if y > 0]
    if pos:
        assert abs(m.mape - sum(abs((p - y) / y) for y, p in pos) / len(pos)) < 1e-9
    else:
        assert math.isnan(m.mape)


# ---- profiles ---------------------------------------------------------------

small_values = st.lists(maybe(st.integers(-30, 30).map(lambda v: v / 2)), min_size=1, max_size=60)


@settings(**SETTINGS)
@given(small_values, small_values)
def test_profiles_match_python_model(spark, a, b):
    n = max(len(a), len(b))
    a, b = a + [None] * (n - len(a)), b + [None] * (n - len(b))
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")

    stats = {r.column_name: r for r in numeric_stats(df, ["a", "b"]).collect()}
    modes = {}
    for r in mode_top(df, ["a", "b"], 10).collect():
        modes.setdefault(r.column_name, []).append((r["rank"], r.value, r["count"]))
    for name, col in (("a", a), ("b", b)):
        vals = [v for v in col if v is not None]
        s = stats[name]
        assert s.non_null_count == len(vals)
        if not vals:
            assert s.mean_value is None and s.median_value is None and name not in modes
            continue
        assert abs(s.mean_value - mean(vals)) < 1e-9
        assert s.min_value == min(vals) and s.max_value == max(vals)
        assert s.median_value == sorted(vals)[(len(vals) - 1) // 2]  # exact lower median at this size
        if len(vals) > 1:
            assert abs(s.stddev_value - stdev(vals)) < 1e-9
        want = sorted(Counter(vals).items(), key=lambda kv: (-kv[1], kv[0]))[:10]
        assert [(v, c) for _, v, c in sorted(modes[name])] == want


@settings(**SETTINGS)
@given(st.lists(st.tuples(maybe(st.integers(-20, 20)), maybe(st.sampled_from(["b", "a", "10", "9", " x"]))), min_size=1, max_size=40))
def test_distinct_lists_match_python_model(spark, rows):
    df = spark.createDataFrame(rows, "n int, s string")
    got = {}
    for r in distinct_lists(df, ["n", "s"], exclude={"n": [0]}).collect():
        got.setdefault(r.column_name, []).append(r.value)
    want_n = [str(v) for v in sorted({n for n, _ in rows if n is not None and n != 0})]
    want_s = sorted({s for _, s in rows if s is not None})
    assert got.get("n", []) == want_n
    assert got.get("s", []) == want_s
