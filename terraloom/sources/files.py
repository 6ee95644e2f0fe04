"""Readers and writers of tile folders, lists, cities, land indexes, logs and GeoJSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.select import LEAST_LAND

CITY = "n string, name string, la double, lo double, p double"
LOG = "idx long, tile_lat int, tile_lon int, status string, nodes long, download_ms long, quadtree_ms long"
RING = "array<array<double>>"


def read_tile_dir(spark: SparkSession, folder: str, kind: str = "terrain") -> DataFrame:
    """tile_lat, tile_lon and payload of ``lon_lat`` files, of all layers where the folder has such; other names and keys off the grid are skipped."""
    suffix = {"terrain": "qtree", "population": "pop"}[kind]
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}").load(folder)
    parts = F.split(F.regexp_extract("path", r"([^/]*)\.[a-z]+$", 1), "_")
    whole = r"^[+-]?\d+$"
    keyed = files.withColumn("_p", parts).filter(F.size("_p") == 2).filter(F.col("_p")[0].rlike(whole) & F.col("_p")[1].rlike(whole))
    keyed = keyed.withColumns({"tile_lon": F.col("_p")[0].try_cast("int"), "tile_lat": F.col("_p")[1].try_cast("int")})
    keyed = keyed.filter(F.col("tile_lat").between(-90, 89) & F.col("tile_lon").between(-180, 179))
    headed = F.substring("content", 1, 4) == F.lit(b"QTR5")
    return keyed.select("tile_lat", "tile_lon", F.when(headed, F.expr("substring(content, 17)")).otherwise(F.col("content")).alias("payload"))


def read_raster_layers(layers: DataFrame, layer: str, no_data: float = -9999.0) -> DataFrame:
    """Pixels of tile arrays (tile_id, height, width, values); no-data is 0 and nothing is below 0."""
    cells = layers.select("tile_id", "width", F.posexplode("values").alias("at", "v"))
    value = F.greatest(F.when(F.col("v") == no_data, 0.0).otherwise(F.col("v")), F.lit(0.0))
    return cells.select("tile_id", F.floor(F.col("at") / F.col("width")).cast("int").alias("r"), (F.col("at") % F.col("width")).cast("int").alias("c"), value.alias(layer))


def parse_tile_list(lines: DataFrame, start: int = 0, limit: int = 0, line: str = "line", order: str = "line_no") -> DataFrame:
    """tile_lat and tile_lon of ``lon,lat`` lines, cut by comma, tab or blank.

    Blank lines, comments, and lines of fewer than two whole numbers are skipped; the slice
    counts what is left, in line order.
    """
    text = F.trim(line)
    parts = F.filter(F.split(F.translate(text, "\t ", ",,"), ","), lambda x: x != "")
    good = lines.filter((text != "") & ~text.startswith("#")).withColumn("_p", parts).filter(F.size("_p") >= 2)
    good = good.withColumns({"tile_lon": F.col("_p")[0].try_cast("int"), "tile_lat": F.col("_p")[1].try_cast("int")}).filter("tile_lon is not null and tile_lat is not null").drop("_p")
    if start or limit:
        good = good.orderBy(order)
        good = good.offset(start) if start else good
        good = good.limit(limit) if limit else good
    return good


def read_tile_list(spark: SparkSession, path: str, start: int = 0, limit: int = 0) -> DataFrame:
    """A list file; lines keep their order by their place in the file."""
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.monotonically_increasing_id().alias("line_no"))
    return parse_tile_list(lines, start, limit)


def write_lines(lines: DataFrame, path: str, column: str = "line") -> None:
    lines.select(column).write.text(path)


def write_tile_list(tiles: DataFrame, path: str, limit: int = 0) -> None:
    """``lon,lat`` lines in file-name order, within each part file and from file to file."""
    from ..operators.audit import problem_lines

    write_lines(problem_lines(tiles, limit), path)


def read_cities(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Cities of JSON arrays without those at 0, 0; the name from either field.

    An array is a whole file, or (for large lists) a line.
    """
    raw = spark.read.option("multiLine", whole_files).schema(CITY).json(path)
    la, lo = F.coalesce("la", F.lit(0.0)), F.coalesce("lo", F.lit(0.0))
    return raw.select(F.coalesce("n", "name", F.lit("?")).alias("n"), la.alias("la"), lo.alias("lo"), F.coalesce("p", F.lit(0.0)).alias("p")).filter("not (la = 0 and lo = 0)")


def read_land_index(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("multiLine", True).schema("tiles array<array<int>>").json(path).select(F.explode("tiles").alias("t"))
    return rows.select(F.col("t")[0].alias("tile_lat"), F.col("t")[1].alias("tile_lon"))


def write_land_index(land: DataFrame, path: str, least: int = LEAST_LAND) -> bool:
    """Writes the sorted index as one JSON object if it is large enough (at most a row per cell of the grid)."""
    cells = land.select("tile_lat", "tile_lon").distinct()
    if cells.count() < least:
        return False
    pairs = F.transform(F.sort_array(F.collect_list(F.struct("tile_lat", "tile_lon"))), lambda t: F.array(t["tile_lat"], t["tile_lon"]))
    cells.agg(pairs.alias("tiles")).select(F.lit(least).alias("min_trust_count"), F.size("tiles").alias("count"), "tiles").write.json(path)
    return True


def write_bake_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").json(path)


def read_bake_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).json(path)


def _point(p: Column) -> Column:
    return (F.size(p) >= 2) & p[0].isNotNull() & p[1].isNotNull()


def read_geojson_rings(spark: SparkSession, path: str, max_features: int = 0, whole_files: bool = True) -> DataFrame:
    """Exterior rings (lon, lat points) of polygons: a collection, one feature, or a list of them.

    Points without two numbers are dropped, then rings of fewer than three points; holes and
    other geometries are ignored. A collection is a whole file, or (for large ones) a line;
    ``max_features`` (0: all) counts the features of each.
    """
    text = spark.read.text(path, wholetext=whole_files)
    feature = "struct<geometry:struct<type:string,coordinates:string>>"
    body = F.from_json("value", f"struct<type:string,features:array<{feature}>,geometry:struct<type:string,coordinates:string>>")
    as_list = F.from_json("value", f"array<{feature}>")
    one = F.array(F.struct(F.col("o.geometry").alias("geometry")))
    features = F.when(F.ltrim("value").startswith("["), as_list).when(F.col("o.type") == "FeatureCollection", F.col("o.features")).when(F.col("o.type") == "Feature", one)
    rows = text.withColumn("o", body).select(F.posexplode(features).alias("feature", "f"))
    rows = rows.filter(F.col("feature") < max_features) if max_features > 0 else rows
    rings = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.try_element_at(F.from_json("f.geometry.coordinates", f"array<{RING}>"), F.lit(1)))).when(F.col("f.geometry.type") == "MultiPolygon", F.transform(F.from_json("f.geometry.coordinates", f"array<array<{RING}>>"), lambda p: F.try_element_at(p, F.lit(1))))
    found = rows.select("feature", F.posexplode(rings).alias("part", "ring")).filter("ring is not null")
    return found.withColumn("ring", F.filter("ring", _point)).filter(F.size("ring") >= 3)


def geojson_extent(rings: DataFrame) -> DataFrame:
    """Bounds of all rings with a margin of 2 % of a span of at least 1e-6."""
    points = rings.select(F.explode("ring").alias("p")).select(F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat"))
    b = points.agg(F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north"))
    dx, dy = (F.greatest(F.lit(1e-6), F.col(x) - F.col(y)) * 0.02 for x, y in (("east", "west"), ("north", "south")))
    return b.select((F.col("west") - dx).alias("west"), (F.col("east") + dx).alias("east"), (F.col("south") - dy).alias("south"), (F.col("north") + dy).alias("north"))
