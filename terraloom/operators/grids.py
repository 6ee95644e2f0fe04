"""Cells of boxes, of the globe and of shares of it, and sampling points."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import keys


def _cells(df: DataFrame, low_lat: Column, high_lat: Column, low_lon: Column, high_lon: Column) -> DataFrame:
    """A row per cell of half-open ranges, clamped to the grid; empty ranges give no row."""
    a, b = F.greatest(low_lat, F.lit(-90)), F.least(high_lat, F.lit(90)) - 1
    c, d = F.greatest(low_lon, F.lit(-180)), F.least(high_lon, F.lit(180)) - 1
    ranged = df.withColumns({"_a": a.cast("int"), "_b": b.cast("int"), "_c": c.cast("int"), "_d": d.cast("int")}).filter("_a <= _b and _c <= _d")
    ranged = ranged.withColumn("tile_lat", F.explode(F.sequence("_a", "_b"))).withColumn("tile_lon", F.explode(F.sequence("_c", "_d")))
    return ranged.drop("_a", "_b", "_c", "_d")


def bbox_tiles(boxes: DataFrame, lat_min: str = "lat_min", lat_max: str = "lat_max", lon_min: str = "lon_min", lon_max: str = "lon_max") -> DataFrame:
    """The cells that each box covers; its corners may come in either order."""
    lats, lons = (F.col(lat_min), F.col(lat_max)), (F.col(lon_min), F.col(lon_max))
    return _cells(boxes, F.floor(F.least(*lats)), F.ceil(F.greatest(*lats)), F.floor(F.least(*lons)), F.ceil(F.greatest(*lons)))


#: Boxes are covered by blocks of 2 ** scale cells a side; the coarsest block holds the whole grid.
SCALES = range(10)


def box_keys(boxes: DataFrame, low_lat: Column, high_lat: Column, low_lon: Column, high_lon: Column, most: int = 4) -> DataFrame:
    """Adds scale, block_row and block_col: the blocks of one scale that cover each box of cells (half-open ranges).

    The scale is the smallest at which a box is at most ``most`` blocks long, so a box of any
    size has at most (most + 1) ** 2 rows. Ranges are clamped to the grid; empty ones give no row.
    """
    a, b = F.greatest(low_lat, F.lit(-90)) + 90, F.least(high_lat, F.lit(90)) + 89
    c, d = F.greatest(low_lon, F.lit(-180)) + 180, F.least(high_lon, F.lit(180)) + 179
    ranged = boxes.withColumns({"_a": a.cast("int"), "_b": b.cast("int"), "_c": c.cast("int"), "_d": d.cast("int")}).filter("_a <= _b and _c <= _d")
    long = F.greatest(F.col("_b") - F.col("_a"), F.col("_d") - F.col("_c")) + 1
    scale = F.lit(SCALES[-1])
    for k in reversed(SCALES[:-1]):
        scale = F.when(long <= most << k, k).otherwise(scale)
    blocks = {n: F.call_function("shiftright", f, F.col("scale")) for n, f in zip("abcd", (F.col("_a"), F.col("_b"), F.col("_c"), F.col("_d")), strict=True)}
    keyed = ranged.withColumn("scale", scale).withColumn("block_row", F.explode(F.sequence(blocks["a"], blocks["b"]))).withColumn("block_col", F.explode(F.sequence(blocks["c"], blocks["d"])))
    return keyed.drop("_a", "_b", "_c", "_d")


def cell_keys(cells: DataFrame) -> DataFrame:
    """Adds scale, block_row and block_col: a row for the block of each scale that holds a cell."""
    keyed = cells.withColumn("scale", F.explode(F.array(*(F.lit(k) for k in SCALES))))
    block = {"block_row": F.col("tile_lat") + 90, "block_col": F.col("tile_lon") + 180}
    return keyed.withColumns({k: F.call_function("shiftright", v.cast("int"), F.col("scale")) for k, v in block.items()})


BLOCK = ["scale", "block_row", "block_col"]


def cells_of_footprint(items: DataFrame) -> DataFrame:
    """Distinct cells of item boxes, with one more row and column than the box touches.

    Cells of the grid are asked whether a box holds them; boxes are never spelled out as cells.
    """
    ends = {"_s": F.floor("lat_min"), "_n": F.ceil("lat_max") + 1, "_w": F.floor("lon_min"), "_e": F.ceil("lon_max") + 1}
    boxes = items.select(*(v.alias(k) for k, v in ends.items())).distinct()
    covers = box_keys(boxes, *(F.col(k) for k in ends))
    cells = cell_keys(global_tiles(items.sparkSession).select("tile_lat", "tile_lon")).alias("x")
    held = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in BLOCK] + [F.col("tile_lat") >= F.col("_s"), F.col("tile_lat") < F.col("_n"), F.col("tile_lon") >= F.col("_w"), F.col("tile_lon") < F.col("_e")]
    return cells.join(covers.alias("y"), keys.all_of(held), "left_semi").select("tile_lat", "tile_lon").distinct()


def global_tiles(spark: SparkSession) -> DataFrame:
    """All 64,800 cells, by latitude and then longitude."""
    index = F.col("id").cast("int")
    return spark.range(keys.WIDTH * keys.HEIGHT).select(index.alias("tile_idx"), keys.index_lat(index).alias("tile_lat"), keys.index_lon(index).alias("tile_lon"))


def split_tiles(tiles: DataFrame, part: int, of: int) -> DataFrame:
    """Every ``of``-th tile from the ``part``-th on, in grid order.

    A row's place is the number of rows of latitudes below, and its place in its own; rows of the
    same cell are taken in order of their other columns.
    """
    if not 1 <= part <= of:
        raise ValueError("a part is 1 to the number of parts")
    below = running_starts(tiles, F.col("tile_lat"), F.count("*"))
    ties = [c for c in tiles.columns if c not in ("tile_lat", "tile_lon")]
    place = F.row_number().over(Window.partitionBy("_group").orderBy("tile_lon", *ties)) - 1
    placed = tiles.withColumn("_group", F.col("tile_lat")).join(F.broadcast(below), "_group").withColumn("_place", F.col("_start") + place)
    return placed.filter(F.col("_place") % of == part - 1).select(tiles.columns)


def running_starts(rows: DataFrame, group: Column, total: Column) -> DataFrame:
    """_group and _start: the total of all groups that come before, in order.

    Groups are rows or columns of the grid, so the driver gets 360 totals at most.
    """
    sums = rows.filter(group.isNotNull()).groupBy(group.alias("_group")).agg(total.cast("long").alias("n")).orderBy("_group").collect()
    starts = accumulate((r["n"] or 0 for r in sums), initial=0)
    kind = dict(rows.select(group.alias("_group")).dtypes)["_group"]
    return rows.sparkSession.createDataFrame([(r["_group"], s) for r, s in zip(sums, starts, strict=False)], f"_group {kind}, _start long")


def tile_sample_points(tiles: DataFrame, g: int) -> DataFrame:
    """g x g interior points per tile: frac_lat, frac_lon and their numbers."""
    steps = F.sequence(F.lit(1), F.lit(max(1, g)))
    grid = tiles.withColumn("row", F.explode(steps)).withColumn("col", F.explode(steps))
    step = 1.0 / (max(1, g) + 1)
    return grid.withColumn("frac_lat", F.col("row") * step).withColumn("frac_lon", F.col("col") * step)


def bbox_sample_grid(boxes: DataFrame, rows: int, cols: int | None = None, falling: bool = False) -> DataFrame:
    """rows x cols points per box with both ends included; latitude rises, or falls for heat maps."""
    rows, cols = max(2, rows), max(2, cols or rows)
    grid = boxes.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    share = F.col("row") / F.lit(float(rows - 1))
    span = F.col("lat_max") - F.col("lat_min")
    la = F.col("lat_max") - span * share if falling else F.col("lat_min") + span * share
    return grid.withColumn("la", la).withColumn("lo", F.col("lon_min") + (F.col("lon_max") - F.col("lon_min")) * (F.col("col") / F.lit(float(cols - 1))))


def overview_sample_grid(tiles: DataFrame, k: int) -> DataFrame:
    """k x k cell-centred points per tile."""
    grid = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    return grid.withColumn("la", F.col("tile_lat") + (F.col("i") + 0.5) / k).withColumn("lo", F.col("tile_lon") + (F.col("j") + 0.5) / k)


def city_sample_offsets(cities: DataFrame, g: int, radius: float) -> DataFrame:
    """The city's point (sample 0) and g x g offsets within the radius, the zero offset once."""
    step = 2 * radius / (g - 1) if g > 1 else 0.0
    values = [-radius + i * step for i in range(g)] if g > 1 else []
    offsets = [(0.0, 0.0)] + [(a, b) for a in values for b in values if a or b]
    items = F.array(*(F.struct(F.lit(i).alias("sample"), F.lit(a).alias("d_lat"), F.lit(b).alias("d_lon")) for i, (a, b) in enumerate(offsets)))
    out = cities.withColumn("_o", F.explode(items)).select("*", "_o.*").drop("_o")
    return out.withColumn("sample_la", F.col("la") + F.col("d_lat")).withColumn("sample_lo", F.col("lo") + F.col("d_lon"))
