"""Filters, source choice and joins on tile keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CELL = ["tile_lat", "tile_lon"]
#: An index of fewer land cells is not trusted.
LEAST_LAND = 12_000


def tile_key_of(tiles: DataFrame) -> list[str]:
    """What tells tiles apart: tile_id and cell, or the cell alone where there is no tile_id."""
    return ["tile_id", *CELL] if "tile_id" in tiles.columns else CELL


def grid_cells(land: DataFrame) -> DataFrame:
    """Distinct cells of the grid, 64,800 at most."""
    return land.select(*CELL).filter(F.col("tile_lat").between(-90, 89) & F.col("tile_lon").between(-180, 179)).distinct()


def is_trusted(land: DataFrame) -> bool:
    return grid_cells(land).count() >= LEAST_LAND


def likely_ocean(tiles: DataFrame, land: DataFrame, trusted: bool | None = None) -> DataFrame:
    """Adds is_ocean: not in the land index, and never where the index isn't trusted.

    The index has at most one row per cell of the grid, so it is broadcast.
    """
    trusted = is_trusted(land) if trusted is None else trusted
    index = F.broadcast(grid_cells(land).withColumn("_land", F.lit(True)))
    return tiles.join(index, CELL, "left").withColumn("is_ocean", F.lit(trusted) & F.col("_land").isNull()).drop("_land")


def is_empty_raster() -> Column:
    """Missing, without pixels, or zero throughout."""
    return F.coalesce(F.col("n_px"), F.lit(0)).eqNullSafe(0) | ((F.col("v_min") == 0) & (F.col("v_max") == 0))


def source_fallback(candidates: DataFrame) -> DataFrame:
    """The first source by priority of each tile whose raster isn't empty."""
    return candidates.filter(~is_empty_raster()).groupBy("tile_id").agg(F.min("prio").alias("prio"))


def filter_cities(cities: DataFrame, west: float, south: float, east: float, north: float, limit: int, min_pop: float, order: str = "city_id") -> DataFrame:
    """Cities in a box, edges included; then the first ``limit`` (0: all); then those of enough people."""
    inside = cities.filter(F.col("lo").between(west, east) & F.col("la").between(south, north))
    return (inside.orderBy(order).limit(limit) if limit else inside).filter(F.col("p") >= min_pop)


def retry_candidates(files: DataFrame, land: DataFrame) -> DataFrame:
    """Tiles of one byte at most on cells that aren't likely ocean."""
    return likely_ocean(files.filter("terrain_bytes <= 1"), land).filter("not is_ocean").drop("is_ocean")


def pair_tiles(terrain: DataFrame, population: DataFrame, key: list[str] = CELL) -> DataFrame:
    """Rows of both layers of the same tile; ``key`` tells tiles apart, where a cell may have several."""
    return terrain.join(population, key)


def skip_existing(wanted: DataFrame, files: DataFrame, land: DataFrame, rebake: bool = True) -> DataFrame:
    """Cells still to be baked: without both files, or (rebake) with a one-byte terrain on likely land."""
    done = files.filter("terrain_bytes is not null and pop_bytes is not null")
    if rebake:
        done = likely_ocean(done, land).filter("terrain_bytes > 1 or is_ocean")
    return wanted.join(done.select(*CELL), CELL, "left_anti")


def best_footprint(tiles: DataFrame, items: DataFrame) -> DataFrame:
    """The item of the largest overlap with each tile, the smallest id on ties.

    Items meet tiles by blocks of cells of the scale that suits their box, and then by the exact
    box. The best of each tile is found by an aggregation, which begins before the shuffle.
    """
    from .grids import BLOCK, box_keys, cell_keys

    lat, lon = [(F.least(f"{x}_min", f"{x}_max"), F.greatest(f"{x}_min", f"{x}_max")) for x in ("lat", "lon")]
    covers = box_keys(items, F.floor(lat[0]), F.ceil(lat[1]), F.floor(lon[0]), F.ceil(lon[1]))
    pairs = cell_keys(tiles.select(*CELL).distinct()).join(covers, BLOCK)
    high = F.least("lat_max", F.col("tile_lat") + 1) - F.greatest("lat_min", "tile_lat")
    wide = F.least("lon_max", F.col("tile_lon") + 1) - F.greatest("lon_min", "tile_lon")
    scored = pairs.withColumn("area", high * wide).filter((high > 0) & (wide > 0))
    best = F.max(F.struct("area", (-F.col("item_id")).alias("id"))).alias("best")
    return scored.groupBy(*CELL).agg(best).select(*CELL, (-F.col("best.id")).alias("item_id"), F.col("best.area").alias("area"))


def land_index(items: DataFrame) -> DataFrame:
    """Cells of the items of the four quarters of the world, and of all items where they are few."""
    from .grids import cells_of_footprint

    def quarter(north: bool, east: bool) -> DataFrame:
        la, lo = F.col("lat_max") > 0, F.col("lon_max") > 0
        return cells_of_footprint(items.filter((la if north else F.col("lat_min") < 0) & (lo if east else F.col("lon_min") < 0)))

    found = quarter(True, True).union(quarter(True, False)).union(quarter(False, True)).union(quarter(False, False)).distinct()
    return found if found.count() >= LEAST_LAND else found.union(cells_of_footprint(items)).distinct()
