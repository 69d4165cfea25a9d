"""Boxes, evaluation grids and station neighbourhoods.

Distances are only computed between points in neighbouring cells of a lon/lat grid, or in cells that a search over a
tree of them has left, so no operator
here pairs every centre with every station.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.geo import EARTH_RADIUS, haversine
from gridtide.operators.rows import first_per
from gridtide.session import cut

# Cell sizes are 360 / 2**level degrees, from about 40 km down to one cell for the whole globe.
LEVELS = (10, 8, 6, 4, 2, 0)
CELL = ["level", "cx", "cy", "part"]
# Levels of the tree of cells that is searched for near points; the last has at most 2**19 cells.
TREE = (2, 4, 6, 8, 10)


def bounding_boxes(
    points: DataFrame, key: str, lon: str = "longitude", lat: str = "latitude", axis_order: str = "lat_lon"
) -> DataFrame:
    """Box, centre, side lengths and first search radius (half the diagonal, rounded up)."""
    box = points.groupBy(key).agg(
        F.min(lon).alias("min_lon"),
        F.max(lon).alias("max_lon"),
        F.min(lat).alias("min_lat"),
        F.max(lat).alias("max_lat"),
        F.count("*").alias("n_points"),
    )
    west, east, south, north = (F.col(c) for c in ("min_lon", "max_lon", "min_lat", "max_lat"))
    sides = box.select(
        "*",
        ((east - west) / 2 + west).alias("c_lon"),
        ((north - south) / 2 + south).alias("c_lat"),
        haversine(north, west, north, east, axis_order=axis_order).alias("width_km"),
        haversine(north, west, south, west, axis_order=axis_order).alias("height_km"),
    )
    w, h = F.col("width_km"), F.col("height_km")
    return sides.withColumn("diagonal_km", F.sqrt(w * w + h * h)).withColumn(
        "r0", F.ceil(F.col("diagonal_km") / 2).cast("double")
    )


def grid_lattices(cell_km: float = 10, dense: int = 100) -> Column:
    """Where a field is evaluated over a box row, as an array of lattices, each with `lons` and `lats`.

    A box of up to four cells gets its centre, and the middles of its sides too when it holds at
    least `dense` points; a larger one gets a lattice from side to side plus its centre.
    """
    west, east, south, north = (F.col(c) for c in ("min_lon", "max_lon", "min_lat", "max_lat"))
    nx = (F.floor(F.col("width_km") / cell_km) + 1).cast("int")
    ny = (F.floor(F.col("height_km") / cell_km) + 1).cast("int")

    def lattice(lons: Column, lats: Column) -> Column:
        return F.struct(lons.alias("lons"), lats.alias("lats"))

    def side(n: Column, start: Column, end: Column) -> Column:
        # a side with a single point has no step
        step = F.when(n > 1, (end - start) / (n - 1)).otherwise(F.lit(0.0))
        return F.transform(F.sequence(F.lit(0), n - 1), lambda i: start + i * step)

    mid_lon, mid_lat = F.array("c_lon"), F.array("c_lat")
    centre = lattice(mid_lon, mid_lat)
    small = nx.cast("bigint") * ny <= 4
    return (
        F.when(small & (F.col("n_points") < dense), F.array(centre))
        .when(small, F.array(lattice(mid_lon, F.array(north, south)), lattice(F.array(west, east), mid_lat), centre))
        .otherwise(F.array(lattice(side(nx, west, east), side(ny, north, south)), centre))
    )


def grid_points(cell_km: float = 10, dense: int = 100) -> Column:
    """The points of `grid_lattices`, as an array of (lon, lat)."""

    def rows(g: Column) -> Column:
        return F.flatten(F.transform(g["lats"], lambda y: F.transform(g["lons"], lambda x: F.struct(x.alias("lon"), y.alias("lat")))))

    return F.flatten(F.transform(grid_lattices(cell_km, dense), rows))


def eval_grid(boxes: DataFrame, key: str, cell_km: float = 10, dense: int = 100) -> DataFrame:
    """One row per evaluation point."""
    return boxes.select(key, F.posexplode(grid_points(cell_km, dense)).alias("point", "p")).select(
        key, "point", "p.lon", "p.lat"
    )


# Expressions on cells are SQL text: one call each instead of one per node of the expression.


def _reach(level: int, lat: str) -> str:
    """Kilometres around a point that the 3 x 3 cells about it cover for certain."""
    if level == 0:
        return "double('infinity')"
    size = math.radians(360 / 2**level)
    east_west = f"asin(greatest(0D, cos(radians({lat}))) * {math.sin(min(size, math.pi / 2))!r}D)"
    return f"least({size!r}D, {east_west}) * {EARTH_RADIUS['km'] * (1 - 1e-9)!r}D"


def _cell(level: int, lon: str, lat: str) -> tuple[str, str]:
    n = 2**level
    return f"floor(({lon} + 180) * {n / 360!r}D) % {n}", f"floor(({lat} + 90) * {n / 360!r}D)"


def _shares(level: int) -> int:
    """Parts that the points of a cell are dealt to. A large cell may hold most points; only few
    centres look at it, so these are copied to all its parts."""
    return 2 ** max(0, 6 - level)


def _cells_around(level: int, lon: str, lat: str) -> str:
    """Array of (level, cx, cy, part): the cell of a point and its neighbours, round the globe."""
    x, y = _cell(level, lon, lat)
    steps = "array(-1, 0, 1)" if level else "array(0)"
    return (
        f"flatten(transform(sequence(0, {_shares(level) - 1}), part -> flatten(transform({steps}, dx -> transform({steps}, dy -> named_struct("
        f"'level', {level}, 'cx', int(pmod({x} + dx, {2**level})), 'cy', int({y} + dy), 'part', part))))))"
    )


def _point_cells(points: DataFrame, lon: str, lat: str, levels: Sequence[int]) -> DataFrame:
    own = ", ".join(
        f"named_struct('level', {level}, 'cx', int(pmod({x}, {2**level})), 'cy', int({y}), "
        f"'part', int(pmod(xxhash64({lon}, {lat}), {_shares(level)})))"
        for level in levels
        for x, y in [_cell(level, lon, lat)]
    )
    return points.selectExpr("*", f"explode(array({own})) AS cell").select(*points.columns, "cell.*")


def pairs_within(
    centres: DataFrame,
    points: DataFrame,
    radius: str,
    centre_at: tuple[str, str] = ("c_lon", "c_lat"),
    point_at: tuple[str, str] = ("longitude", "latitude"),
) -> DataFrame:
    """Centres joined to the points within each centre's own radius (km), with `dist_km`.

    Every centre searches the finest grid whose neighbouring cells cover its radius.
    """
    finest = " ".join(
        f"WHEN `{radius}` <= {_reach(level, centre_at[1])} THEN {_cells_around(level, *centre_at)}"
        for level in LEVELS
    )
    probes = centres.selectExpr("*", f"explode(CASE {finest} END) AS cell").select(*centres.columns, "cell.*")
    # points need a row only for the cell sizes that some centre uses
    used = sorted(r.level for r in probes.select("level").distinct().collect())
    near = probes.join(_point_cells(points, *point_at, used or LEVELS[:1]), CELL)
    dist = haversine(*[F.col(c) for c in (*centre_at[::-1], *point_at[::-1])])
    return (
        near.withColumn("dist_km", dist)
        .where(F.col("dist_km") <= F.col(radius))
        .drop(*CELL)
    )


def ring_radius(
    centres: DataFrame,
    points: DataFrame,
    key: str,
    min_extra: int = 3,
    step_km: float = 10,
    centre_at: tuple[str, str] = ("c_lon", "c_lat"),
    point_at: tuple[str, str] = ("longitude", "latitude"),
) -> DataFrame:
    """(key, radius_km): `r0` grown by whole rings until `min_extra` further points are inside.

    The ring that holds the `min_extra`-th smallest distance beyond `r0` gives the radius at once. It is
    looked for best-first over a tree of cells that count their points: from one level to the next, a
    centre keeps the cells that may hold a point beyond `r0` and up to the distance by which its cells have
    enough of them for certain. Only points in what is left at the finest level are met, so a centre oceans
    away from a crowd of points meets few. Centres with fewer further points than asked for take them all.
    """
    keys = [key, *centre_at, "r0"]
    own = ", ".join(f"named_struct('level', {level}, 'cx', int(pmod({x}, {2**level})), 'cy', int({y}))" for level in TREE for x, y in [_cell(level, *point_at)])
    counted = points.selectExpr(f"explode(array({own})) AS cell").groupBy("cell").agg(F.count("*").alias("n"))
    counted = cut(counted.select("cell.*", "n"), "cells")
    # a quarter of the globe's width each
    tops = counted.where(F.col("level") == TREE[0]).select("cx", "cy", "n").collect()
    if not tops:
        return centres.select(key, F.lit(math.inf).alias("radius_km"))
    cells = F.array(*[F.struct(F.lit(t.cx).alias("cx"), F.lit(t.cy).alias("cy"), F.lit(t.n).alias("n")) for t in tops])
    left = centres.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.*")
    for level in TREE:
        if level != TREE[0]:
            split = 2 ** (level - before)
            inner = counted.where(F.col("level") == level).selectExpr(f"int(floor(cx / {split})) AS ox", f"int(floor(cy / {split})) AS oy", "cx", "cy", "n")
            outer = left.withColumnsRenamed({"cx": "ox", "cy": "oy"}).drop("n")
            left = outer.join(F.broadcast(inner), ["ox", "oy"]).select(*keys, "cx", "cy", "n")  # at most 2**(2 * level - 1) rows
        left, before = _nearest_cells(left, keys, centre_at, level, min_extra), level
    x, y = _cell(TREE[-1], *point_at)
    placed = points.selectExpr(*point_at, f"int(pmod({x}, {2 ** TREE[-1]})) AS cx", f"int({y}) AS cy")
    dist = haversine(*[F.col(c) for c in (*centre_at[::-1], *point_at[::-1])])
    seen = left.select(*keys, "cx", "cy").join(placed, ["cx", "cy"]).select(*keys, dist.alias("d")).where("d > r0")
    # `row_number() <= k` is also applied before the shuffle, so a crowded cell stays cheap
    ranked = seen.selectExpr("*", f"row_number() over (partition by `{key}` order by d) as rn").where(F.col("rn") <= min_extra)
    last = ranked.where(F.col("rn") == min_extra).select(key, (F.col("r0") + step_km * F.ceil((F.col("d") - F.col("r0")) / step_km)).alias("radius_km"))
    found = centres.select(key).join(last, key, "left")
    return cut(found.select(key, F.coalesce(F.col("radius_km").cast("double"), F.lit(math.inf)).alias("radius_km")), "radius")


def _nearest_cells(left: DataFrame, keys: list[str], centre_at: tuple[str, str], level: int, enough: int) -> DataFrame:
    """Cells that may hold one of the `enough` nearest points beyond `r0` of a centre."""
    side = 360 / 2**level
    middle = haversine(F.col(centre_at[1]), F.col(centre_at[0]), (F.col("cy") + 0.5) * side - 90, (F.col("cx") + 0.5) * side - 180)
    # half a side north or south and half a side east or west, which is shorter off the equator
    reach = math.radians(side) * EARTH_RADIUS["km"] * (1 + 1e-9)
    bounds = left.withColumn("near", middle - reach).withColumn("far", middle + reach)
    by_key = Window.partitionBy(*keys)
    sure = F.sum(F.when(F.col("near") > F.col("r0"), F.col("n")).otherwise(0)).over(by_key.orderBy("far", "cx", "cy"))
    bounds = bounds.withColumn("sure", sure).withColumn("limit", F.min(F.when(F.col("sure") >= enough, F.col("far"))).over(by_key))
    kept = bounds.where((F.col("far") > F.col("r0")) & (F.col("limit").isNull() | (F.col("near") <= F.col("limit"))))
    return kept.select(*keys, "cx", "cy", "n")


def ring_neighbours(
    boxes: DataFrame,
    stations: DataFrame,
    key: str,
    station: str = "station_code",
    lon: str = "longitude",
    lat: str = "latitude",
    min_extra: int = 3,
    step_km: float = 10,
    axis_order: str = "lat_lon",
) -> DataFrame:
    """(key, station, lon, lat, dist_km, radius_km): the stations that describe each box."""
    centre_at, point_at = ("c_lon", "c_lat"), (lon, lat)
    if axis_order == "legacy":
        centre_at, point_at = centre_at[::-1], point_at[::-1]
    sites = first_per(
        stations.select(station, lon, lat).where(F.col(lon).isNotNull() & F.col(lat).isNotNull()),
        [station],
        [lon, lat],
    )
    sites = cut(sites, "sites")
    centres = boxes.select(key, "c_lon", "c_lat", "r0")
    radii = ring_radius(centres, sites, key, min_extra, step_km, centre_at, point_at)
    return pairs_within(centres.join(radii, key), sites, "radius_km", centre_at, point_at).select(
        key, station, lon, lat, "dist_km", "radius_km"
    )
