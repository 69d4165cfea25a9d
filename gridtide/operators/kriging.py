"""Kriging with a constant trend and a squared-exponential covariance.

The samples of a key become one row, whose set of places has a fingerprint. Rows are grouped by that
fingerprint, so a task holds the matrices of one set of places at a time, and its fields share the
covariances that the search for length scales starts from. Equal samples are fitted once and met with
their keys by a join. A fitted field is a row of numbers (trend, scales, one weight per sample), so
prediction is a plain Spark expression and a fitted field is stored by writing the table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.session import cut, spread

# Length scales are multiples of the extent of the samples along each axis: those where a search
# starts, and those it may not leave.
SCALES = (0.1, 0.25, 0.5, 1.0, 2.0, 4.0)
LIMITS = (0.02, 20.0)
NUGGET = 1e-8
STEPS = 40  # of a search
TOLERANCE = 1e-5  # slope of the log likelihood, per unit of the logarithm of a scale, at which it ends
HELD = 1 << 22  # numbers of the matrices that are worked on at once
FIELDS, WORK = 256, 1e9  # keys of a set of places in one task: at most so many, or so much work

SAMPLE = T.StructType([T.StructField(f, T.DoubleType()) for f in ("lon", "lat", "w")])
FITTED = [
    T.StructField("variable", T.StringType()),
    T.StructField("trend", T.DoubleType()),
    T.StructField("scale_lon", T.DoubleType()),
    T.StructField("scale_lat", T.DoubleType()),
    T.StructField("weights", T.ArrayType(SAMPLE)),
    T.StructField("error", T.StringType()),
]


class Places:
    """Covariances of one set of places, and the log likelihood of fields over them."""

    def __init__(self, xy: np.ndarray):
        self.n = len(xy)
        self.extent = np.maximum(np.ptp(xy, axis=0), 1e-6)
        self.gaps = [(xy[:, i, None] - xy[None, :, i]) ** 2 for i in (0, 1)]
        self.low, self.high = (np.log(limit * self.extent) for limit in LIMITS)

    def covariance(self, log_scales: np.ndarray) -> np.ndarray:
        """A matrix for each row of logarithms of scales, without the nugget."""
        a, b = np.exp(-2 * log_scales.T)
        return np.exp(-0.5 * (self.gaps[0] * a[:, None, None] + self.gaps[1] * b[:, None, None]))

    def solved(self, k: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.linalg.solve(k + NUGGET * np.eye(self.n), right)

    def likelihood(self, log_scales: np.ndarray, fields: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Profile log likelihood of each field (a row) at its scales, and its slopes."""
        k = self.covariance(log_scales)
        noisy = k + NUGGET * np.eye(self.n)
        sign, size = np.linalg.slogdet(noisy)
        inverse = np.linalg.inv(noisy)
        ones = inverse.sum(axis=2)
        trend = (ones * fields).sum(axis=1) / ones.sum(axis=1)
        rest = fields - trend[:, None]
        alpha = np.einsum("bij,bj->bi", inverse, rest)
        variance = np.maximum((rest * alpha).sum(axis=1) / self.n, 1e-300)
        value = np.where(sign > 0, -0.5 * (self.n * np.log(variance) + size), -np.inf)
        slopes = np.empty_like(log_scales)
        for axis in (0, 1):
            change = k * (self.gaps[axis] * np.exp(-2 * log_scales[:, axis])[:, None, None])
            moved = np.einsum("bi,bij,bj->b", alpha, change, alpha) / variance
            slopes[:, axis] = 0.5 * (moved - np.einsum("bij,bji->b", inverse, change))
        return value, np.where(np.isfinite(value)[:, None], slopes, 0.0)

    def starts(self, fields: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best of the fixed scales for each field, and its log likelihood; matrices serve all fields."""
        pairs = [(a, b) for a in SCALES for b in SCALES] if self.n > 1 else [(1.0, 1.0)]
        tried = np.log(np.array(pairs) * self.extent)
        right = np.column_stack([np.ones(self.n), fields.T])
        values = np.full((len(tried), len(fields)), -np.inf)
        for some in _shares(len(tried), self.n):
            noisy = self.covariance(tried[some]) + NUGGET * np.eye(self.n)
            sign, size = np.linalg.slogdet(noisy)
            made = np.linalg.solve(noisy, np.broadcast_to(right, (len(noisy), *right.shape)))
            one, ys = made[:, :, 0], made[:, :, 1:]
            trend = ys.sum(axis=1) / one.sum(axis=1)[:, None]
            rest = fields.T[None] - trend[:, None, :]
            square = (rest * (ys - one[:, :, None] * trend[:, None, :])).sum(axis=1)
            fit = -0.5 * (self.n * np.log(np.maximum(square / self.n, 1e-300)) + size[:, None])
            values[some] = np.where((sign > 0)[:, None] & np.isfinite(fit), fit, -np.inf)
        best = values.argmax(axis=0)
        return tried[best], values.max(axis=0)

    def search(self, fields: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Scales of highest likelihood from `start` on: bounded quasi-Newton steps, of all fields at once.

        A step is only taken where it raises the likelihood; a scale at its limit stays there while the
        likelihood rises beyond it.
        """
        x = start.copy()
        value, slope = self.likelihood(x, fields)
        curve = np.tile(np.eye(2), (len(x), 1, 1))  # inverse of the curvature, as far as it is known
        live = np.arange(len(x))
        for _ in range(STEPS):
            stuck = ((x[live] <= self.low) & (slope[live] < 0)) | ((x[live] >= self.high) & (slope[live] > 0))
            up = np.where(stuck, 0.0, slope[live])
            go = np.abs(up).max(axis=1, initial=0) > TOLERANCE
            live, up, stuck = live[go], up[go], stuck[go]
            if not len(live):
                break
            step = np.where(stuck, 0.0, np.einsum("bij,bj->bi", curve[live], up))
            step = np.where(((step * up).sum(axis=1) > 0)[:, None], step, up)
            step /= np.maximum(np.abs(step).max(axis=1), 1.0)[:, None]
            waiting, length = np.arange(len(live)), 1.0
            moved = np.zeros(len(live), bool)
            for _half in range(12):
                at = live[waiting]
                trial = np.clip(x[at] + length * step[waiting], self.low, self.high)
                new, new_slope = self.likelihood(trial, fields[at])
                good = new > value[at] + 1e-4 * (up[waiting] * (trial - x[at])).sum(axis=1)
                done, kept = at[good], waiting[good]
                curve[done] = _curved(curve[done], trial[good] - x[done], slope[done] - new_slope[good])
                x[done], value[done], slope[done] = trial[good], new[good], new_slope[good]
                moved[kept] = True
                waiting, length = waiting[~good], length / 2
                if not len(waiting):
                    break
            live = live[moved]
        return x


def _curved(inverse: np.ndarray, step: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The quasi-Newton update of each inverse curvature; where the slope does not fall, steps become longer."""
    along = (step * change).sum(axis=1)
    fine = along > 1e-10
    scale = (1 / np.where(fine, along, 1.0))[:, None, None]
    left = np.eye(2) - scale * step[:, :, None] * change[:, None, :]
    made = left @ inverse @ left.transpose(0, 2, 1) + scale * step[:, :, None] * step[:, None, :]
    return np.where(fine[:, None, None], made, 4 * inverse)


def _shares(count: int, n: int) -> list[np.ndarray]:
    """Places of `count` matrices of size n in shares that are held at once."""
    return np.array_split(np.arange(count), -(-count * n * n // HELD)) if count else []


def solve(xy: np.ndarray, values: np.ndarray) -> list[tuple[float, float, float, np.ndarray]]:
    """Per column of `values`: trend, two length scales and the sample weights.

    The scales are those of highest likelihood; their search starts from the best of `SCALES`.
    """
    if not (np.isfinite(xy).all() and np.isfinite(values).all()):
        raise ValueError("a sample is not a finite number")
    places, fields = Places(xy), np.ascontiguousarray(values.T)
    scales, value = places.starts(fields)
    if not np.isfinite(value).all():
        raise np.linalg.LinAlgError("no length scale gives a solvable system")
    out = []
    for some in _shares(len(fields), places.n):
        if places.n > 1:
            scales[some] = places.search(fields[some], scales[some])
        right = np.stack([np.ones_like(fields[some]), fields[some]], axis=2)
        one, ys = np.moveaxis(places.solved(places.covariance(scales[some]), right), 2, 0)
        trend = ys.sum(axis=1) / one.sum(axis=1)
        weights = ys - one * trend[:, None]
        out += [(float(t), *map(float, s), w) for t, s, w in zip(trend, np.exp(scales[some]), weights, strict=True)]
    return out


def gathered(samples: DataFrame, keys: Sequence[str], coords: tuple[str, str], values: Sequence[str]) -> DataFrame:
    """One row per key: `lons`, `lats`, `fields` (an array per variable), in a fixed order of places, with
    the fingerprints `place_set` (of the places) and `content` (of all of it)."""
    one = F.struct(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate([*coords, *values])])
    rows = samples.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("rows"))
    columns = [F.col("rows")[f"c{k}"] for k in range(2 + len(values))]
    return rows.select(
        *keys,
        columns[0].alias("lons"),
        columns[1].alias("lats"),
        F.array(*columns[2:]).alias("fields"),
        _fingerprint(*columns[:2]).alias("place_set"),
        _fingerprint(*columns, F.lit(",".join(values))).alias("content"),
    )


def _fingerprint(*columns: Column) -> Column:
    """128 bits."""
    return F.concat_ws("-", F.hex(F.xxhash64(*columns)), F.hex(F.xxhash64(F.lit("other"), *columns)))


def _fit_set(values: Sequence[str], table: pa.Table) -> pa.Table:
    """The fields of rows that share a set of places."""
    lons, lats = (table[c][0].values.to_numpy(zero_copy_only=False) for c in ("lons", "lats"))
    xy = np.column_stack([lons, lats])
    out, wanted = [], []
    for content, fields in zip(table["content"].to_pylist(), table["fields"]):
        numbers = np.stack([f.values.to_numpy(zero_copy_only=False) for f in fields])
        if not (np.isfinite(xy).all() and np.isfinite(numbers).all()):
            out.append((content, None, None, None, None, None, "a sample is not a finite number"))
            continue
        for name, field in zip(values, numbers, strict=True):
            if (field == 0).all():
                out.append((content, name, 0.0, 1.0, 1.0, [], None))
            else:
                wanted.append((content, name, field))
    try:
        fitted = solve(xy, np.column_stack([field for *_names, field in wanted])) if wanted else []
    except (np.linalg.LinAlgError, ValueError) as problem:
        bad = {content for content, *_rest in wanted}
        out = [row for row in out if row[0] not in bad] + [(c, None, None, None, None, None, str(problem)) for c in sorted(bad)]
        fitted = []
    places = xy.tolist()
    for (content, name, _field), (trend, sx, sy, w) in zip(wanted, fitted, strict=False):
        weights = [{"lon": a, "lat": b, "w": c} for (a, b), c in zip(places, w.tolist(), strict=True)]
        out.append((content, name, trend, sx, sy, weights, None))
    sample = pa.struct([(f, pa.float64()) for f in ("lon", "lat", "w")])
    kinds = [pa.string(), pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.list_(sample), pa.string()]
    names = ["content", *(f.name for f in FITTED)]
    return pa.table([pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)], names=names)


def _fit_rows(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Fits rows of `gathered`; equal contents once. A set that many rows share is dealt to several tasks."""
    once = rows.dropDuplicates(["content"])
    each = F.greatest(F.lit(1.0), F.least(F.lit(float(FIELDS)), F.floor(WORK / F.pow(F.first(F.size("lons")), F.lit(3)))))
    parts = rows.groupBy("place_set").agg(F.ceil(F.count("*") / each).alias("parts"))
    dealt = once.join(parts, "place_set").withColumn("part", F.pmod(F.xxhash64("content"), F.col("parts")))
    fields = T.StructType([T.StructField("content", T.StringType()), *FITTED])

    def fit(table: pa.Table) -> pa.Table:
        return _fit_set(values, table)

    group = ["place_set", "part"]
    return spread(dealt.select(*group, "content", "lons", "lats", "fields"), group).groupBy(*group).applyInArrow(fit, fields)


def fit_kriging(samples: DataFrame, keys: Sequence[str], coords: tuple[str, str], values: Sequence[str]) -> DataFrame:
    """One row per key and variable: `trend, scale_lon, scale_lat, weights, error`.

    A variable that is 0 at every sample is 0 everywhere and is not fitted. A key that cannot be
    solved yields one row with `error` and no variable.
    """
    rows = cut(gathered(samples, keys, coords, values), "gathered")
    return rows.select(*keys, "content").join(_fit_rows(rows, values), "content").drop("content")


def _sum(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda total, x: total + value(x))


def _decay(gap: Column, scale: Column) -> Column:
    return F.exp((gap / scale) * (gap / scale) * F.lit(-0.5))


def field_at(lon: Column, lat: Column) -> Column:
    """Value of a fitted row at one point."""
    near = lambda s: s["w"] * _decay(lon - s["lon"], F.col("scale_lon")) * _decay(lat - s["lat"], F.col("scale_lat"))
    return F.col("trend") + _sum(F.col("weights"), near)


def field_mean(grid: Column) -> Column:
    """Mean value of a fitted row over an array of lattices, each with its `lons` and `lats`.

    A station's mean covariance with a lattice is a sum along one axis times a sum along the other, so
    the work grows with the sides of the grid, not with its points.
    """
    count = _sum(grid, lambda g: (F.size(g["lons"]) * F.size(g["lats"])).cast("double"))

    def mean_covariance(s: Column) -> Column:
        def lattice(g: Column) -> Column:
            along = _sum(g["lons"], lambda x: _decay(x - s["lon"], F.col("scale_lon")))
            return along * _sum(g["lats"], lambda y: _decay(y - s["lat"], F.col("scale_lat")))

        return _sum(grid, lattice)

    return F.col("trend") + _sum(F.col("weights"), lambda s: s["w"] * mean_covariance(s)) / count


def krige(
    samples: DataFrame,
    grid: DataFrame,
    keys: Sequence[str],
    coords: tuple[str, str],
    values: Sequence[str],
    on: Sequence[str],
) -> DataFrame:
    """Fields fitted per key and averaged over the grid of the key's area.

    `grid` has the columns `on` and `lattices`, see `field_mean`. Groups that failed are left out; see
    `fit_kriging` for their errors.
    """
    return predict_kriging(fit_kriging(samples, keys, coords, values), grid, keys, values, on)


def predict_kriging(
    fitted: DataFrame, grid: DataFrame, keys: Sequence[str], values: Sequence[str], on: Sequence[str]
) -> DataFrame:
    mean = fitted.where(F.col("error").isNull()).join(grid, list(on)).select(
        *keys, "variable", field_mean(F.col("lattices")).alias("value")
    )
    return mean.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variable") == v, F.col("value"))).alias(v) for v in values]
    )


class FieldStore:
    """Fitted fields in a folder, partitioned by one of their keys.

    A field is found by its keys and by the content of its samples, so fields whose samples have changed
    are fitted again.
    """

    def __init__(self, spark: SparkSession, path: str, by: str = "month"):
        self.spark, self.path, self.by = spark, path, by

    def _read(self, asked: DataFrame) -> DataFrame | None:
        """The partitions from the first to the last that is asked for; None before the first write."""
        fields = T.StructType([*asked.schema.fields, *FITTED])
        try:
            stored = self.spark.read.schema(fields).parquet(self.path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        first, last = asked.agg(F.min(self.by), F.max(self.by)).first()
        return stored.where(F.col(self.by).between(F.lit(first), F.lit(last)))

    def missing(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of `gathered` whose fields are not in the store."""
        stored = self._read(rows.select(*keys, "content"))
        return rows if stored is None else rows.join(stored.select(*keys, "content"), [*keys, "content"], "left_anti")

    def fields(self, samples: DataFrame, keys: Sequence[str], coords: tuple[str, str], values: Sequence[str]) -> DataFrame:
        """As `fit_kriging`, but only what the store lacks is fitted, and added to it."""
        known = [*keys, "content"]
        rows = cut(gathered(samples, keys, coords, values), "gathered")
        lacking = cut(self.missing(rows, keys), "missing")
        if not lacking.isEmpty():
            fitted = lacking.select(*known).join(_fit_rows(lacking, values), "content")
            spread(fitted.select(*known, *(f.name for f in FITTED)), [self.by]).write.partitionBy(self.by).mode("append").parquet(self.path)
        stored = self._read(rows.select(*known))
        if stored is None:
            return fit_kriging(samples, keys, coords, values)  # of nothing
        return stored.join(rows.select(*known), known, "left_semi").drop("content")
