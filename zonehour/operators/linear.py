"""M1-M6 without a vector per row: zone index, sparse assembly, and the elastic
net from its normal equations.

The one-hot block of the Gram matrix is diagonal, so counts and sums by zone
with the moments of the other features hold all of it (an arrowhead). For a
given intercept and other coefficients each zone's coefficient has a closed
form. What is left is a problem as small as the other features, solved by
Newton steps whose sums over the zones are one aggregate each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from zonehour.config import MSG_NO_TRAIN_ROWS, ForecastSpec
from zonehour.operators.positions import dense_positions
from zonehour.session import scratch_path

ZONE, ZONE_FEATURE = "PULocationID", "PULocationID_ohe"
MSG_BAD_FEATURE = "the training side has nulls or NaN in {columns}"
DRIVER_ZONES = 1 << 13  # up to so many zones the sums over them are taken on the driver
TOLERANCE = 1e-12


def zone_index(train: DataFrame, zone: str = ZONE) -> DataFrame:
    """M1: (zone, zone_index) of every zone in ``train``: from 0 by number of
    rows, most first, ties by the zone as text. Null is no zone. Counted and
    ranked by Spark; no label comes to the driver."""
    counted = train.where(F.col(zone).isNotNull()).groupBy(zone).agg(F.count(F.lit(1)).alias("_rows"))
    order = [F.desc("_rows"), F.col(zone).cast("string").asc()]
    return dense_positions(counted, order, name="zone_index").select(zone, "zone_index")


def assemble_features(rows: DataFrame, index: DataFrame, spec: ForecastSpec = ForecastSpec(), zone: str = ZONE) -> DataFrame:
    """M2 + M3: ``rows`` with zone_index and ``features``, a sparse vector as
    (size, indices, values) in the order of ``spec.features``. The one-hot
    block has a place more than the zones, for those that ``index`` lacks."""
    zones = index.count()
    width = {c: zones + 1 if c == ZONE_FEATURE else 1 for c in spec.features}
    starts = np.cumsum([0, *width.values()]).tolist()
    # the index has a row per zone: a hot zone repeats on the side of the rows only
    joined = rows.join(index, zone, "left").withColumn("zone_index", F.coalesce("zone_index", F.lit(zones)))
    places = [(F.col("zone_index") if c == ZONE_FEATURE else F.lit(0)) + F.lit(at) for c, at in zip(spec.features, starts)]
    values = [F.lit(1.0) if c == ZONE_FEATURE else F.col(c).cast("double") for c in spec.features]
    vector = F.struct(F.lit(starts[-1]).cast("bigint").alias("size"), F.array(*[p.cast("bigint") for p in places]).alias("indices"), F.array(*values).alias("values"))
    return joined.withColumn("features", vector)


@dataclass(frozen=True)
class LinearFit:
    """``zones`` (zone, zone_coefficient) is None without the zone feature.
    ``unseen`` is the coefficient of zones that training lacks: that of the
    rows without a zone, or 0."""

    intercept: float
    coefficients: dict[str, float]
    zones: DataFrame | None
    unseen: float
    steps: int


def soft(value: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(value) * np.maximum(np.abs(value) - by, 0)


class DriverZones:
    """What the zones add to the objective, its slope and its curvature at
    (intercept, coefficients): of collected rows (n, t, s0, s1, ...), a zone's
    rows and sums of the target and the features, all standardised."""

    def __init__(self, sums: np.ndarray, rows: int, l1: float, l2: float):
        self.n, self.t, self.arrow = sums[:, 0], sums[:, 1] / rows, np.delete(sums, 1, 1) / rows
        p = self.n / rows
        spread = p * (1 - p) * rows / max(1, rows - 1)
        # a zone that holds every row says nothing beside the intercept
        self.real, self.l1, self.curve = self.n < rows, l1 * np.sqrt(spread), p + l2 * spread

    def coefficients(self, u: np.ndarray) -> np.ndarray:
        return np.where(self.real, soft(self.t - self.arrow @ u, self.l1) / self.curve, 0)

    def at(self, u: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        theta = self.coefficients(u)
        used = self.arrow[theta != 0]
        return float((theta * theta * self.curve).sum() / 2), theta @ self.arrow, used.T @ (used / self.curve[theta != 0][:, None])


class TableZones:
    """The same of a written table of the zones, each time by one aggregate."""

    def __init__(self, table: DataFrame, features: int, rows: int, l1: float, l2: float):
        self.table, self.size = table, features + 1
        p = F.col("n") / rows
        self.arrow = [p, *[F.col(f"s{k}") / rows for k in range(features)]]
        spread = p * (1 - p) * F.lit(rows / max(1, rows - 1))
        self.t, self.real, self.l1, self.curve = F.col("t") / rows, F.col("n") < rows, F.lit(l1) * F.sqrt(spread), p + F.lit(l2) * spread

    def coefficient(self, u: np.ndarray) -> Column:
        rest = self.t
        for x, a in zip(u.tolist(), self.arrow):
            rest = rest - F.lit(x) * a
        return F.when(self.real, F.signum(rest) * F.greatest(F.abs(rest) - self.l1, F.lit(0.0)) / self.curve).otherwise(F.lit(0.0))

    def at(self, u: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        theta, curve, size = F.col("theta"), F.col("curve"), self.size
        held = self.table.select(self.coefficient(u).alias("theta"), self.curve.alias("curve"), *[a.alias(f"a{k}") for k, a in enumerate(self.arrow)])
        pairs = [(i, j) for i in range(size) for j in range(i, size)]
        sums = [F.sum(theta * theta * curve), *[F.sum(theta * F.col(f"a{k}")) for k in range(size)]]
        sums += [F.sum(F.when(theta != 0, F.col(f"a{i}") * F.col(f"a{j}") / curve).otherwise(0.0)) for i, j in pairs]
        out = [float(x or 0) for x in held.agg(*[s.alias(f"v{k}") for k, s in enumerate(sums)]).first()]
        curved = np.zeros((size, size))
        for (i, j), x in zip(pairs, out[size + 1 :]):
            curved[i, j] = curved[j, i] = x
        return out[0] / 2, np.array(out[1 : size + 1]), curved


def descend(curved: np.ndarray, slope: np.ndarray, start: np.ndarray, l1: np.ndarray, sweeps: int = 100_000) -> np.ndarray:
    """The x with the least slope·(x - start) + (x - start)'curved(x - start)/2
    + l1·|x|, by coordinate descent."""
    x, pull = start.copy(), slope.copy()
    for _ in range(sweeps):
        largest = 0.0
        for k in range(len(x)):
            if curved[k, k] <= TOLERANCE:
                continue  # nothing tells this direction from the others
            new = soft(curved[k, k] * x[k] - pull[k], l1[k]) / curved[k, k]
            if step := new - x[k]:
                pull += curved[:, k] * step
                x[k] = new
                largest = max(largest, abs(step))
        if largest < TOLERANCE:
            break
    return x


def fit_normal(train: DataFrame, spec: ForecastSpec = ForecastSpec(), target: str = "trip_count", zone: str = ZONE, driver_zones: int = DRIVER_ZONES) -> LinearFit:
    """M4 + M5: the elastic net of ``target`` on ``spec.features``, features
    and target standardised (a constant one has coefficient 0), the intercept
    free: the exact optimum that ``fit_linear`` nears step by step.

    Two passes over ``train``: means and deviations, then one ``groupBy`` of
    the zone. Up to ``driver_zones`` zones the rows of that come to the
    driver for the Newton steps. Beyond, they are a table in the shared
    scratch folder and each step is a Spark aggregate; the result is the same.
    Training nulls or NaN are an error, as is an empty ``train``. Rows without
    a zone are a zone of their own.
    """
    others = [c for c in spec.features if c != ZONE_FEATURE]
    has_zones = ZONE_FEATURE in spec.features
    inputs = [target, *others]
    # names of their own, in case a feature is called like a sum
    key = F.col(zone) if has_zones else F.lit(None).cast("int")
    plain = train.select(key.alias("zone"), *[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(inputs)])
    each = [F.expr(f"{f}(c{k})") for k in range(len(inputs)) for f in ("count", "avg", "stddev_samp")]
    rows, about, *stats = plain.agg(F.count(F.lit(1)), F.approx_count_distinct("zone"), *each).first()
    if not rows:
        raise ValueError(MSG_NO_TRAIN_ROWS.format(date=spec.train_end))
    count, mean, spread = ([stats[3 * k + i] for k in range(len(inputs))] for i in range(3))
    if bad := [c for c, n, m in zip(inputs, count, mean) if n < rows or m != m]:
        raise ValueError(MSG_BAD_FEATURE.format(columns=", ".join(bad)))
    coefficients = {c: 0.0 for c in others}
    if not spread[0]:
        return LinearFit(mean[0], coefficients, None, 0.0, 0)

    used = [k for k in range(1, len(inputs)) if spread[k]]
    size = len(used)
    scaled = plain.select("zone", *[((F.col(f"c{k}") - F.lit(mean[k])) / F.lit(spread[k])).alias(f"x{i}") for i, k in enumerate([0, *used])])
    pairs = [(i, j) for i in range(size + 1) for j in range(max(1, i), size + 1)]
    held = ["n", "t", *[f"s{k}" for k in range(size)]]
    moments = [f"m{i}_{j}" for i, j in pairs]
    sums = ["count(1)", *[f"sum(x{i})" for i in range(size + 1)], *[f"sum(x{i} * x{j})" for i, j in pairs]]
    grouped = scaled.groupBy("zone").agg(*[F.expr(f"{x} AS {name}") for x, name in zip(sums, held + moments)])
    collected = grouped.limit(driver_zones + 1).collect() if about <= driver_zones else []
    table = None
    if not 0 < len(collected) <= driver_zones:
        path = scratch_path(train.sparkSession, "normal-equations")
        grouped.write.parquet(path)
        table = train.sparkSession.read.parquet(path)
        total = table.agg(*[F.sum(c) for c in held[1:] + moments]).first()
    else:
        total = np.array([r[2:] for r in collected], float).sum(0).tolist()
    total = dict(zip(held[1:] + moments, (x / rows for x in total)))

    penalty = spec.reg_param / spread[0]
    l1, l2 = penalty * spec.elastic_net, penalty * (1 - spec.elastic_net)
    gram, pull = np.eye(size + 1), np.array([total["t"], *[total[f"m0_{k + 1}"] for k in range(size)]])
    gram[0, 1:] = gram[1:, 0] = [total[f"s{k}"] for k in range(size)]
    for i, j in pairs:
        if i:
            gram[i, j] = gram[j, i] = total[f"m{i}_{j}"] + (l2 if i == j else 0)
    sparse = np.array([0.0] + [l1] * size)
    zones: DriverZones | TableZones | None = None
    if has_zones and table is None:
        zones = DriverZones(np.array([r[1 : len(held) + 1] for r in collected], float), rows, l1, l2)
    elif has_zones:
        zones = TableZones(table, size, rows, l1, l2)

    def objective(u: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        value, slope, curved = zones.at(u) if zones else (0.0, 0.0, 0.0)
        return u @ gram @ u / 2 - u @ pull - value + sparse @ np.abs(u), gram @ u - pull + slope, gram - curved

    at, steps = np.zeros(size + 1), 0
    now = objective(at)
    for steps in range(1, spec.max_iter + 1):
        goal = descend(now[2], now[1], at, sparse)
        if np.abs(goal - at).max() < 1e-10:
            break
        part = 1.0
        while (after := objective(at + part * (goal - at)))[0] > now[0] + 1e-13 and part > 1e-6:
            part /= 2
        at, now = at + part * (goal - at), after

    coefficients |= {inputs[k]: float(w) * spread[0] / spread[k] for k, w in zip(used, at[1:])}
    intercept = mean[0] + spread[0] * float(at[0]) - sum(coefficients[inputs[k]] * mean[k] for k in used)
    if zones is None:
        return LinearFit(intercept, coefficients, None, 0.0, steps)
    if table is None:
        found = [(r.zone, float(x) * spread[0]) for r, x in zip(collected, zones.coefficients(at))]
        without = [x for z, x in found if z is None]
        kind = StructType([StructField(zone, train.schema[zone].dataType), StructField("zone_coefficient", DoubleType())])
        frame = F.broadcast(train.sparkSession.createDataFrame(found, kind))  # driver_zones rows at most
    else:
        frame = table.select(F.col("zone").alias(zone), (zones.coefficient(at) * F.lit(spread[0])).alias("zone_coefficient"))
        without = [r.zone_coefficient for r in frame.where(F.col(zone).isNull()).collect()]
    return LinearFit(intercept, coefficients, frame, without[0] if without else 0.0, steps)


def predict_normal(fit: LinearFit, rows: DataFrame, zone: str = ZONE, name: str = "prediction") -> DataFrame:
    """``rows`` with the prediction of ``fit``. A null feature has none."""
    value = F.lit(fit.intercept)
    for c, b in fit.coefficients.items():
        value = value + F.lit(b) * F.col(c)
    if fit.zones is None:
        return rows.withColumn(name, value)
    zones = fit.zones.withColumnRenamed(zone, "_zone")
    joined = rows.join(zones, F.col(zone).eqNullSafe(F.col("_zone")), "left")
    return joined.withColumn(name, value + F.coalesce("zone_coefficient", F.lit(fit.unseen))).drop("_zone", "zone_coefficient")
