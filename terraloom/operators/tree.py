"""Adaptive quadtrees as tables: node statistics from pixels up, then leaves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import codes, keys
from .pixels import lowest_mode

TILE = ["tile_id", "tile_lat", "tile_lon"]


def quad_pyramid(pixels: DataFrame, levels: int = 5, lowest: int | None = None) -> DataFrame:
    """Statistics of every block of every level from 0 (the tile) to ``lowest``.

    ``pixels`` have dem, pop, zone, urban and grad; a tile has 2 ** levels pixels a side and
    the lowest level has two, unless given. Three groupings in a row and no union: pixels make the
    lowest level, its blocks the two above, and the blocks of the highest of these all further
    levels. Where pixels are dealt by tile nothing is shuffled. Sums, not means, go up: all of
    them are exact for whole numbers.
    """
    lowest = levels - 1 if lowest is None else lowest
    side = 1 << (levels - lowest)
    first = pixels.withColumn("qr", F.floor(F.col("r") / side).cast("int")).withColumn("qc", F.floor(F.col("c") / side).cast("int"))
    level = first.groupBy(*TILE, "qr", "qc").agg(
        F.count("*").alias("n"), F.sum("dem").alias("s"), F.sum(F.col("dem") * F.col("dem")).alias("ss"), F.min("dem").alias("low"), F.max("dem").alias("high"),
        *(F.sum(F.when(F.col("zone") == z, 1).otherwise(0)).alias(f"z{z}") for z in codes.ZONES),
        F.sum("pop").alias("ps"), F.sum(F.col("pop") * F.col("pop")).alias("pss"), F.max("pop").alias("most"), F.max("grad").alias("grad"),
        *(F.sum(F.when(F.col("urban") == u, 1).otherwise(0)).alias(f"u{u}") for u in codes.URBAN),
    )
    sums = ["n", "s", "ss", "z0", "z1", "z2", "z3", "ps", "pss", *(f"u{u}" for u in codes.URBAN)]

    def raised(df: DataFrame, wanted: Column) -> DataFrame:
        """Blocks of each of the ``wanted`` levels of each block."""
        up = df.withColumnRenamed("level", "_from").withColumn("level", F.explode(wanted))
        scale = F.pow(F.lit(2.0), F.col("_from") - F.col("level"))
        moved = up.withColumns({q: F.floor(F.col(q) / scale).cast("int") for q in ("qr", "qc")})
        return moved.groupBy(*TILE, "level", "qr", "qc").agg(*(F.sum(c).alias(c) for c in sums), F.min("low").alias("low"), *(F.max(c).alias(c) for c in ("high", "most", "grad")))

    top = max(0, lowest - 2)
    found = raised(level.withColumn("level", F.lit(lowest)), F.sequence(F.lit(top), F.lit(lowest)))
    return raised(found, F.when(F.col("_from") == top, F.sequence(F.lit(0), F.lit(top))).otherwise(F.array("_from"))) if top else found


def _mean(s: str) -> Column:
    return F.col(s) / F.col("n")


def _variance(s: str, ss: str) -> Column:
    return F.col(ss) / F.col("n") - _mean(s) * _mean(s)


def elevation_splits(threshold: float) -> Column:
    mean = _mean("s")
    return (_variance("s", "ss") >= threshold) | (F.greatest(F.abs(F.col("low") - mean), F.abs(F.col("high") - mean)) >= 4.0)


def zone_splits() -> Column:
    top = F.greatest("z0", "z1", "z2", "z3")
    return (top < F.col("n")) & ((F.col("n") - top) / F.col("n") >= 0.02)


def terrain_splits(forced: int = 2, deepest: int = 9) -> Column:
    """Whether a block that isn't the root is divided, the budget apart."""
    parent = F.col("level") - 1
    by_rule = F.when(F.col("z0") == F.col("n"), (F.col("most") > 10) & elevation_splits(1.0)).when(F.col("z0") > 0, zone_splits() | elevation_splits(5.0)).otherwise(zone_splits() | elevation_splits(1.0))
    return F.when(parent < forced, True).when(parent >= deepest, False).otherwise(by_rule)


def population_splits(forced: int = 3, deepest: int = 9) -> Column:
    parent, mean = F.col("level") - 1, _mean("ps")
    kinds = sum((F.when(F.col(f"u{u}") > 0, 1).otherwise(0) for u in list(codes.URBAN)[2:]), F.when(F.col("u1") > 0, 1).otherwise(0))
    hot = F.col("most") >= F.greatest(3 * mean, mean + 25)
    return F.when((parent >= deepest) | (F.col("most") <= 1.0), False).when(parent < forced, True).otherwise((kinds > 1) | hot | (_variance("ps", "pss") >= 16))


def _leaves(pyramid: DataFrame, splits: Column, levels: int) -> DataFrame:
    """Blocks that aren't divided while all above them are, with path and place.

    Blocks of a tile are nested stretches of one curve through its smallest blocks. In the order
    of the curve, larger blocks first, a block lies in one that stopped before exactly if it
    begins before the furthest end of those. So one window by tile tells, without a join.
    """
    path = reduce(lambda acc, k: F.when(F.col("level") == k, keys.block_path(F.col("qr"), F.col("qc"), k)).otherwise(acc), range(1, levels), F.lit(""))
    nodes = pyramid.withColumn("path", path).withColumn("splits", (F.col("level") == 0) | ((F.col("level") < levels - 1) & splits))
    bits = sum((F.shiftright(F.col(q), i).bitwiseAND(F.lit(1)).cast("long") * (1 << (2 * i + k)) for k, q in enumerate(("qc", "qr")) for i in range(levels - 1)), F.lit(0).cast("long"))
    length = F.pow(F.lit(4.0), F.lit(levels - 1) - F.col("level")).cast("long")
    nodes = nodes.withColumn("_length", length).withColumn("_begin", bits * F.col("_length"))
    before = Window.partitionBy(*TILE).orderBy("_begin", "level").rowsBetween(Window.unboundedPreceding, -1)
    stopped = F.max(F.when(~F.col("splits"), F.col("_begin") + F.col("_length"))).over(before)
    kept = nodes.withColumn("_stopped", F.coalesce(stopped, F.lit(0))).filter(~F.col("splits") & (F.col("_begin") >= F.col("_stopped"))).drop("_length", "_begin", "_stopped")
    size = F.lit(1 << levels) / F.pow(F.lit(2.0), F.col("level"))
    return kept.withColumn("size", size.cast("int")).withColumn("r0", (F.col("qr") * F.col("size")).cast("int")).withColumn("c0", (F.col("qc") * F.col("size")).cast("int"))


def terrain_zone() -> Column:
    """The most frequent zone of a block; water with people or above sea level is Natural."""
    mode = lowest_mode([F.col(f"z{z}") for z in codes.ZONES])
    return F.when((mode == 0) & ((_mean("s") > 0) | (F.col("most") > 10)), 1).otherwise(mode).cast("int")


def population_urban() -> Column:
    return codes.urban_from_density(lowest_mode([F.col(f"u{u}") for u in codes.URBAN]), _mean("ps"))


def terrain_codes() -> Column:
    """The node that a block is as a leaf."""
    return codes.terrain_node(_mean("s"), terrain_zone(), codes.gradient_level(F.col("grad")))


def population_codes() -> Column:
    return codes.population_node(_mean("ps"), population_urban())


def terrain_leaves(pyramid: DataFrame, levels: int = 5) -> DataFrame:
    """A row per leaf of the terrain tree where no budget binds: mean, zone and gradient."""
    out = _leaves(pyramid, terrain_splits(), levels)
    return out.select(*TILE, "path", "level", "r0", "c0", "size", _mean("s").alias("elev"), terrain_zone().alias("zone"), codes.gradient_level(F.col("grad")).alias("gradient"))


def population_leaves(pyramid: DataFrame, levels: int = 5) -> DataFrame:
    """A row per leaf of the population tree where no budget binds: density and urban type."""
    out = _leaves(pyramid, population_splits(), levels)
    return out.select(*TILE, "path", "level", "r0", "c0", "size", _mean("ps").alias("density"), population_urban().alias("urban"))
