"""Fusing layers, repairing water, gradients, and statistics per tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from ..functions import codes

POP_PIXEL = 10.0
KEYS = ["tile_id", "tile_lat", "tile_lon"]


def layer_arrays(pixels: DataFrame, layer: str) -> DataFrame:
    """One row per tile that has the layer: its values in row order."""
    cells = F.sort_array(F.collect_list(F.struct("r", "c", F.col(layer).alias("v"))))
    return pixels.filter(F.col(layer).isNotNull()).groupBy(*KEYS).agg(F.transform(cells, lambda x: x["v"]).alias(layer))


def fuse_layers(dem: DataFrame, pop: DataFrame, cover: DataFrame, size: int = 32) -> DataFrame:
    """Pixels of tiles with elevation, joined with the other layers by tile, not by pixel.

    Inputs have one row per tile. A missing population is 0; missing land cover is Natural
    and not urban.
    """
    both = dem.join(pop.select("tile_id", "pop"), "tile_id", "left").join(cover.select("tile_id", "esa"), "tile_id", "left")
    cells = both.select(*KEYS, "pop", "esa", F.posexplode("dem").alias("at", "dem"))
    klass = F.get("esa", F.col("at"))
    return cells.select(*KEYS, F.floor(F.col("at") / size).cast("int").alias("r"), (F.col("at") % size).alias("c"), "dem", F.coalesce(F.get("pop", F.col("at")), F.lit(0.0)).alias("pop"), codes.landcover_zone(klass).alias("zone"), codes.landcover_urban(klass).alias("urban"))


def with_zones(pixels: DataFrame) -> DataFrame:
    """Long pixels with zone and urban from the class, and population 0 where missing."""
    return pixels.withColumn("zone", codes.landcover_zone(F.col("esa"))).withColumn("urban", codes.landcover_urban(F.col("esa"))).withColumn("pop", F.coalesce("pop", F.lit(0.0)))


def fix_water(pixels: DataFrame) -> DataFrame:
    """Water with people, or above sea level, becomes Natural; what stays water has no people."""
    one = F.when((F.col("zone") == 0) & (F.col("pop") > POP_PIXEL), 1).otherwise(F.col("zone"))
    urban = F.when((F.col("zone") == 0) & (F.col("pop") > POP_PIXEL), 0).otherwise(F.col("urban"))
    two = F.when((F.col("dem") > 0) & (F.col("_zone") == 0), 1).otherwise(F.col("_zone"))
    out = pixels.withColumns({"_zone": one, "_urban": urban}).withColumn("_zone", two)
    dry = F.col("_zone") != 0
    return out.withColumns({"zone": F.col("_zone").cast("int"), "pop": F.when(dry, F.col("pop")).otherwise(0.0), "urban": F.when(dry, F.col("_urban")).otherwise(0).cast("int")}).drop("_zone", "_urban")


def correction_counts(pixels: DataFrame) -> DataFrame:
    """Pixels per tile that the first and the second pass of ``fix_water`` change."""
    first = (F.col("zone") == 0) & (F.col("pop") > POP_PIXEL)
    second = (F.col("zone") == 0) & ~first & (F.col("dem") > 0)
    return pixels.groupBy("tile_id").agg(F.count_if(first).alias("pass1"), F.count_if(second).alias("pass2"))


def whole_tiles(pixels: DataFrame, size: int = 32, with_elevation: bool = False) -> DataFrame:
    """Pixels of tiles that have all ``size`` x ``size`` of them, dealt by tile.

    One shuffle, which serves all windows and groupings by tile that follow. With
    ``with_elevation`` only tiles whose elevation isn't missing or zero throughout.
    """
    tile = Window.partitionBy("tile_id")
    facts = {"_n": F.count("*").over(tile)} | ({"_low": F.min("dem").over(tile), "_high": F.max("dem").over(tile)} if with_elevation else {})
    whole = pixels.withColumns(facts).filter(F.col("_n") == size * size)
    return (whole.filter("not (_low = 0 and _high = 0)") if with_elevation else whole).drop(*facts)


def gradients(values: Column, side: int) -> Column:
    """The largest difference of each value of a tile array to a neighbour; rows are ``side`` long.

    Differences to the next value, and to the value a row further on, are made once and laid
    against both of their ends. A missing neighbour or value counts as no difference.
    """
    n = side * side
    zero = F.lit(0.0)

    def steps(by: int) -> Column:
        return F.zip_with(F.slice(values, 1, n - by), F.slice(values, 1 + by, n - by), lambda a, b: F.coalesce(F.abs(a - b), zero))

    def both_ends(found: Column, by: int) -> Column:
        edge = F.array_repeat(zero, by)
        return F.zip_with(F.concat(edge, found), F.concat(found, edge), lambda a, b: F.greatest(a, b))

    along = F.transform(steps(1), lambda x, i: F.when((i + 1) % side == 0, zero).otherwise(x))
    return F.zip_with(both_ends(along, 1), both_ends(steps(side), side), lambda a, b: F.greatest(a, b)) if side > 1 else F.transform(values, lambda _: zero)


def pixel_gradient(tiles: DataFrame, side: int, layer: str = "dem") -> DataFrame:
    """Adds grad to rows of tile arrays: see ``gradients``. No row per pixel, no shuffle."""
    return tiles.withColumn("grad", gradients(F.col(layer), side))


def exploded(tiles: DataFrame, side: int, *layers: str) -> DataFrame:
    """A row per pixel of tile arrays: r, c and the layers; a tile's rows stay in its task."""
    cells = F.transform(F.arrays_zip(*layers), lambda x, i: F.struct(F.floor(i / side).cast("int").alias("r"), (i % side).cast("int").alias("c"), *(x[k].alias(k) for k in layers)))
    return tiles.select(*KEYS, F.inline(cells))


def resample_layer(layers: DataFrame, layer: str, size: int, nearest: bool | None = None) -> DataFrame:
    """Tile arrays resized to size x size, corners on corners: layers of whole numbers by the nearest value, others linearly.

    ``nearest`` decides instead of the layer's type. Linear values are blended by rows and then
    by columns. A null array becomes zeros; an array that has the size already is left alone.
    """
    kind = layers.schema[layer].dataType.elementType
    nearest = isinstance(kind, IntegralType) if nearest is None else nearest
    v, n = F.col(layer), F.sqrt(F.size(layer)).cast("int")
    at = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: i * ((F.col("_n") - 1) / F.lit(float(max(1, size - 1)))))
    if nearest:
        places = F.transform("_at", lambda x: F.floor(x + 0.5).cast("int"))
        made = F.flatten(F.transform(places, lambda r: F.transform(places, lambda c: F.get(v, r * F.col("_n") + c))))
    else:
        low = F.transform("_at", lambda x: F.least(F.floor(x).cast("int"), F.greatest(F.col("_n") - 2, F.lit(0))))
        marks = F.zip_with("_at", low, lambda x, k: F.struct(k.alias("low"), F.least(k + 1, F.col("_n") - 1).alias("high"), (x - k).alias("share")))

        def row(m: Column) -> Column:
            return F.zip_with(F.slice(v, m["low"] * F.col("_n") + 1, F.col("_n")), F.slice(v, m["high"] * F.col("_n") + 1, F.col("_n")), lambda a, b: a * (1 - m["share"]) + b * m["share"])

        made = F.flatten(F.transform(F.transform("_marks", row), lambda x: F.transform("_marks", lambda m: F.get(x, m["low"]) * (1 - m["share"]) + F.get(x, m["high"]) * m["share"])))
    zeros = F.array_repeat(F.lit(0).cast(kind if nearest else "double"), size * size)
    listed = layers.select("tile_id", layer, n.alias("_n")).withColumn("_at", at)
    listed = listed if nearest else listed.withColumn("_marks", marks)
    same = v if nearest else v.cast("array<double>")
    return listed.select("tile_id", F.when(v.isNull(), zeros).when(F.col("_n") == size, same).otherwise(made).alias(layer))


def zone_histogram(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("tile_id").agg(*(F.count_if(F.col("zone") == z).alias(f"zone_{z}") for z in codes.ZONES))


def water_share(pixels: DataFrame) -> DataFrame:
    """Share of water in the raw land cover of tiles that have it; over 0.95 is ocean."""
    share = F.avg(F.when(F.col("esa") == codes.WATER_CLASS, 1.0).otherwise(0.0))
    return pixels.filter(F.col("esa").isNotNull()).groupBy("tile_id").agg(share.alias("water_share")).withColumn("is_ocean", F.col("water_share") > 0.95)


def lowest_mode(counts: list[Column]) -> Column:
    """Number of the largest count, the lowest on ties."""
    out = F.lit(len(counts) - 1)
    top = F.greatest(*counts)
    for i in reversed(range(len(counts) - 1)):
        out = F.when(counts[i] == top, i).otherwise(out)
    return out.cast("int")


def zone_mode(pixels: DataFrame) -> DataFrame:
    counted = zone_histogram(pixels)
    return counted.select("tile_id", lowest_mode([F.col(f"zone_{z}") for z in codes.ZONES]).alias("zone"))


def node_budget(pixels: DataFrame, terrain_cap: int = 24_000, population_cap: int = 20_000) -> DataFrame:
    """Node budgets of the two trees of a tile."""
    high = min(30_000, max(5_000, terrain_cap))
    wide = min(30_000, max(3_000, population_cap))
    facts = pixels.groupBy("tile_id").agg(F.count_distinct("zone").alias("zones"), F.max("pop").alias("most"))
    terrain = F.when((F.col("zones") > 1) | (F.col("most") > 50), high).otherwise(min(high, 12_000))
    people = F.when(F.col("most") > 1000, wide).when(F.col("most") > 10, min(wide, 12_000)).otherwise(min(wide, 4_000))
    return facts.select("tile_id", terrain.alias("terrain_budget"), people.alias("population_budget"))


def dealt(rows: DataFrame, parts: int | None, key: list[str] = KEYS) -> DataFrame:
    """Rows dealt by tile into ``parts`` partitions, so that a task holds as many tiles whatever the input; as Spark likes where that is None."""
    return rows.repartition(*key) if parts is None else rows.repartition(parts, *key)


def tile_facts(pixels: DataFrame, size: int | None = None, arrays: bool = False, parts: int | None = None) -> DataFrame:
    """Per tile: pixels, whether layers are there (an all-zero elevation isn't), and water facts.

    One grouping. With ``size`` only tiles that have size x size pixels. With ``arrays`` also
    ``cells``: the repaired pixels in row order; pixels are then dealt into ``parts`` before they
    are collected, as collecting where they are read would hold all that a task reads.
    """
    listed = [F.sort_array(F.collect_list(F.struct("r", "c", "dem", "pop", "zone", "urban"))).alias("cells")] if arrays else []
    raw = (dealt(pixels, parts) if arrays else pixels).withColumns({"_dem": F.col("dem"), "_esa": F.col("esa")})
    facts = fix_water(with_zones(raw)).groupBy(*KEYS).agg(
        F.count("*").alias("n"), F.min("_dem").alias("low"), F.max("_dem").alias("high"), F.count("_esa").alias("cover"),
        F.avg(F.when(F.col("_esa") == codes.WATER_CLASS, 1.0).when(F.col("_esa").isNotNull(), 0.0)).alias("water_share"), F.max("zone").alias("top_zone"), F.max("pop").alias("most"), *listed,
    )
    facts = facts if size is None else facts.filter(F.col("n") == size * size)
    has = F.col("low").isNotNull() & ~((F.col("low") == 0) & (F.col("high") == 0))
    return facts.select(*KEYS, "n", has.alias("has_dem"), (F.col("cover") > 0).alias("has_cover"), "water_share", ((F.col("top_zone") == 0) & (F.col("most") <= POP_PIXEL)).alias("all_water"), *(["cells"] if arrays else []))


def bake_status(facts: DataFrame, ocean: Column | None = None, no_data_water: bool = False) -> DataFrame:
    """Adds status: ocean, no_data, water or ok; ``ocean`` tells cells that are likely ocean."""
    empty = F.lit("ocean" if no_data_water else "no_data")
    wet = F.col("has_cover") & (F.col("water_share") > 0.95)
    rest = F.when(~F.col("has_dem"), F.when(wet, "ocean").otherwise(empty)).when(F.col("all_water"), "water").otherwise("ok")
    if ocean is None:
        return facts.withColumn("status", rest)
    far = F.abs("tile_lat") >= 80
    early = F.when(~F.col("has_cover"), empty).when(wet, F.lit("ocean")).when(far, F.lit("no_data")).otherwise(rest)
    return facts.withColumn("status", F.when(ocean, early).otherwise(rest))
