"""Encodings, trees, payloads, packs and files on small inputs."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions import codes, keys
from terraloom.operators import audit, bake, grids, lookup, pack, pixels, select, tree
from terraloom.operators.grids import bbox_tiles, split_tiles
from terraloom.sources import files, packs, tables
from terraloom.sources.folders import write_tile_folder
from terraloom.streaming.bake_log import run_tallies, status_counts, tallies

DATA = "/root/testdata/sf0.001"


def nodes(raw):
    return np.frombuffer(raw, "<u2")


def terrain(dem, zone, pop=None, budget=30_000):
    dem = np.asarray(dem, float)
    zero = np.zeros(dem.shape)
    return bake.tree(bake.Pyramid(dem, np.asarray(zone), zero if pop is None else pop, zero), True, budget)


def test_elevation_codes_err_less_than_their_step(spark):
    df = spark.range(0, 7680).select(F.col("id").cast("double").alias("m")).withColumn("d", codes.decode_elevation(codes.encode_elevation(F.col("m"))))
    step = F.when(F.col("m") < 512, 1).when(F.col("m") < 1536, 2).when(F.col("m") < 3584, 4).otherwise(8)
    assert df.filter((F.col("d") > F.col("m")) | (F.col("m") - F.col("d") >= step)).count() == 0


def test_codes_of_nulls_are_null(spark):
    row = spark.sql("select cast(null as double) x, cast(null as int) i").select(codes.encode_elevation(F.col("x")), codes.encode_pop_density(F.col("x")), codes.decode_pop_density(F.col("i"))).first()
    assert list(row) == [None, None, None]


def test_off_grid_points_have_no_tile(spark):
    df = spark.createDataFrame([(90.0, 0.0), (0.0, 180.0), (-90.0, -180.0), (None, 1.0)], "la double, lo double")
    assert [r.tile_lat for r in lookup.tile_key(df).collect()] == [None, None, -90, None]


def test_path_and_block_agree(spark):
    df = spark.range(1024).select((F.col("id") % 32).cast("int").alias("c"), F.floor(F.col("id") / 32).cast("int").alias("r"))
    df = df.withColumn("p", keys.point_path(1 - (F.col("r") + 0.5) / 32, (F.col("c") + 0.5) / 32, 5)).withColumn("q", keys.block_path(F.col("r"), F.col("c"), 5))
    assert df.filter("p <> q").count() == 0
    assert df.filter((keys.path_number(F.col("p"), "c") != F.col("c")) | (keys.path_number(F.col("p"), "r") != F.col("r"))).count() == 0


def slope(side, by_row, by_col, base=300.0):
    """A plane that climbs by so many metres a row and a column."""
    return base + by_row * np.arange(side)[:, None] + by_col * np.arange(side)[None, :]


def leaves_of(raw):
    """(path, node) of each leaf of a payload."""
    waiting, out = [""], []
    for node in nodes(raw).tolist():
        path = waiting.pop()
        if node & codes.LEAF:
            out.append((path, node))
        else:
            waiting += [path + q for q in "3210"]
    assert not waiting
    return out


@pytest.mark.parametrize("budget", [5, 21, 90, 333, 1_000, 4_321])
@pytest.mark.parametrize("ground", ["ridge", "rings"])
def test_trees_never_pass_their_budget_and_cover_the_tile(budget, ground):
    y, x = np.mgrid[0:256, 0:256]
    dem = 900 + 40 * np.abs((x + 3 * y) % 61 - 30) if ground == "ridge" else 2_000 + 700 * np.sin(np.hypot(x - 90, y - 140) / 3)
    raw = terrain(dem, 1 + (x // 7 + y // 5) % 3, budget=budget)
    assert nodes(raw)[0] == len(nodes(raw)) <= budget
    assert sum(0.25 ** len(p) for p, _ in leaves_of(raw)) == 1


def test_more_budget_never_gives_fewer_nodes():
    mosaic = np.random.default_rng(2024).integers(1, 4, (64, 64))
    sizes = [len(nodes(terrain(slope(64, 5, 0), mosaic, budget=b))) for b in (30, 120, 480, 1_900, 7_600)]
    assert sizes == sorted(sizes) and sizes[-1] == (4**6 - 1) // 3


@pytest.mark.parametrize("split", [8, 40, 52])
def test_an_edge_between_classes_is_followed_to_the_smallest_blocks(split):
    zone = np.full((64, 64), 2)
    even = terrain(slope(64, 0, 0), zone)
    zone[split:] = 3
    edged = terrain(slope(64, 0, 0), zone)
    # forced levels alone where the edge falls between their blocks, else more along it
    assert len(leaves_of(even)) == 64 and (len(leaves_of(edged)) > 64) == (split % 8 > 0)
    for path, node in leaves_of(edged):
        row = sum(int(q) // 2 << (5 - i) for i, q in enumerate(path))
        assert node & 3 == (2 if row < split else 3)


def test_a_lone_town_is_found_past_the_forced_levels():
    pop = np.zeros((128, 128))
    pop[70, 21] = 900.0
    zero = np.zeros(pop.shape)
    found = leaves_of(bake.tree(bake.Pyramid(zero, np.ones(pop.shape), pop, zero), False, 20_000))
    deepest = [p for p, _ in found if len(p) == 6]
    assert len(deepest) == 4 and len({p[:5] for p in deepest}) == 1
    people = [p for p, node in found if node >> 3 & 0xFFF]
    row, col = (sum((int(q) >> k & 1) << (5 - i) for i, q in enumerate(people[0])) for k in (1, 0))
    assert len(people) == 1 and (row, col) == (70 // 2, 21 // 2)


def test_gradients_look_both_ways():
    dem = np.zeros((8, 8))
    dem[:, 4:] = 260.0
    raw = leaves_of(terrain(dem, np.ones((8, 8))))
    by_column = {}
    for path, node in raw:
        by_column.setdefault(sum((int(q) & 1) << (1 - i) for i, q in enumerate(path)), set()).add(node >> 2 & 3)
    assert by_column == {0: {0}, 1: {3}, 2: {3}, 3: {0}}


@pytest.fixture(scope="module")
def baked(spark):
    from terraloom.plans.queries import fused_tiles

    fused = fused_tiles(spark, DATA).cache()
    return fused, bake.bake_tiles(fused, 32).cache()


def test_payload_leaves_equal_table_leaves(spark, baked):
    fused, tiles = baked
    pyramid = tree.quad_pyramid(pixels.exploded(pixels.pixel_gradient(fused.filter("status = 'ok'"), 32), 32, "dem", "pop", "zone", "urban", "grad"))
    for kind, leaves in (("terrain", tree.terrain_leaves(pyramid).select("tile_lat", "tile_lon", "path", codes.encode_elevation(F.col("elev")).alias("value"), F.col("zone").alias("kind"), "gradient")), ("population", tree.population_leaves(pyramid).select("tile_lat", "tile_lon", "path", codes.encode_pop_density(F.col("density")).alias("value"), F.col("urban").alias("kind"), F.lit(None).cast("int").alias("gradient")))):
        decoded = bake.decode_tiles(tiles, kind, kind == "terrain").select("tile_lat", "tile_lon", "path", "value", "kind", "gradient")
        assert decoded.exceptAll(leaves).count() == 0 and leaves.exceptAll(decoded).count() == 0
        area = decoded.groupBy("tile_lat", "tile_lon").agg(F.sum(F.pow(F.lit(0.25), F.length("path"))).alias("a"))
        assert area.filter("a <> 1").count() == 0


def test_pack_parts_round_trip(spark, baked, tmp_path):
    tiles = baked[1].filter("terrain is not null").select("tile_lat", "tile_lon", F.col("terrain").alias("payload"))
    again = tiles.limit(3).withColumn("payload", F.expr("substring(payload, 1, 1)"))
    assert packs.write_pack_parts(tiles.union(again), str(tmp_path / "packs")) == tiles.count()
    back = packs.read_pack_tiles(spark, str(tmp_path / "packs")).drop("kind")
    assert back.exceptAll(tiles).count() == 0 and back.count() == tiles.count()


def test_tile_folder_skips_foreign_names(spark, baked, tmp_path):
    tiles = baked[1].filter("status = 'ok'").select("tile_lat", "tile_lon", F.col("terrain").alias("payload"))
    write_tile_folder(tiles, str(tmp_path / "tiles"), "qtree")
    for name in ("a_b.qtree", "1_2_3.qtree", "500_1.qtree"):
        (tmp_path / "tiles" / name).write_bytes(b"xx")
    head = tiles.first()
    (tmp_path / "tiles" / "-179_-89.qtree").write_bytes(b"QTR5" + bytes(12) + bytes(head.payload))
    back = files.read_tile_dir(spark, str(tmp_path / "tiles"))
    assert back.count() == tiles.count() + 1
    assert bytes(back.filter("tile_lat = -89 and tile_lon = -179").first().payload) == bytes(head.payload)


@pytest.mark.parametrize("degrees", [1, 25, 45])
def test_shard_files_hold_each_tile_where_their_index_says(spark, degrees):
    cells = [(-90, -180), (-66, -155), (-65, -156), (0, 0), (24, 25), (25, 24), (89, 179), (88, -1)]
    tiles = spark.createDataFrame([(a, b, bytearray([i, 0x80] * (i + 1))) for i, (a, b) in enumerate(cells)], "tile_lat int, tile_lon int, payload binary")
    keyed = {(r.tile_lat, r.tile_lon): r for r in pack.shard_key(tiles, degrees).collect()}
    found, content = {}, {}
    chunks = sorted(pack.shard_chunks(tiles, degrees, chunk_bytes=5).collect(), key=lambda r: (r.path, r.seq))
    for r in chunks:
        whole = content.setdefault(r.path, bytearray())
        assert r.at == len(whole) and (r.seq == 0 or len(r.chunk) < 5 + 1 + 2 * len(cells))
        whole += r.chunk
    assert {p: len(x) for p, x in content.items()} == {r.path: r.file_bytes for r in pack.pack_shards(tiles.withColumn("terrain_bytes", F.length("payload")), degrees).collect()}
    by_path = {f"terrain_{r.shard_lon:+04d}_{r.shard_lat:+03d}.gsh": (r.shard_lat, r.shard_lon, r.tile_w, r.tile_h) for r in keyed.values()}
    for path, whole in content.items():
        lat, lon, w, h = by_path[path]
        body = whole[pack.SHARD_HEADER_BYTES + w * h * pack.SHARD_ENTRY_BYTES :]
        for k, (at, size) in enumerate(struct.iter_unpack(pack.SHARD_ENTRY, whole[pack.SHARD_HEADER_BYTES : pack.SHARD_HEADER_BYTES + w * h * pack.SHARD_ENTRY_BYTES])):
            if size:
                found[(lat + k // w, lon + k % w)] = bytes(body[at : at + size])
    assert found == {c: bytes([i, 0x80] * (i + 1)) for i, c in enumerate(cells)}


def test_root_sizes_are_those_of_the_trees(spark, baked):
    rows = baked[1].filter("status = 'ok'").select("terrain_nodes", pack.root_size(F.col("terrain")).alias("a"), pack.root_size(F.concat(F.lit(b"QTR5" + bytes(12)), "terrain")).alias("b")).collect()
    assert rows and all(r.terrain_nodes == r.a == r.b for r in rows)
    assert [r[0] for r in spark.sql("select unhex('FF') x union all select null union all select unhex('0380')").select(pack.root_size(F.col("x"))).collect()] == [None] * 3


def test_places_of_repeated_cells(spark):
    files_ = spark.createDataFrame([(la, lo, 10 + k) for k, (la, lo) in enumerate([(5, 10), (5, 10), (5, 100), (-3, 10), (7, -1), (200, 1)])], "tile_lat int, tile_lon int, terrain_bytes int")
    rows = sorted(pack.pack_layout(files_).collect(), key=lambda r: r.offset)
    assert [r.name for r in rows] == sorted(r.name for r in rows) and rows[0].offset == 0
    assert all(a.offset + a.size == b.offset for a, b in zip(rows, rows[1:], strict=False)) and len(rows) == 5
    parts = [split_tiles(files_, k, 4).count() for k in (1, 2, 3, 4)]
    assert sum(parts) == 6 and max(parts) - min(parts) <= 1


def test_status_without_an_index_of_oceans(spark):
    facts = spark.createDataFrame([(1, 85, 0, True, False, None, False), (2, 0, 0, True, True, 1.0, True)], "tile_id long, tile_lat int, tile_lon int, has_dem boolean, has_cover boolean, water_share double, all_water boolean")
    assert [r.status for r in pixels.bake_status(facts).orderBy("tile_id").collect()] == ["ok", "water"]
    assert [r.status for r in pixels.bake_status(facts, F.lit(True)).orderBy("tile_id").collect()] == ["no_data", "ocean"]
    assert [r.status for r in pixels.bake_status(facts, F.lit(True), no_data_water=True).orderBy("tile_id").collect()] == ["ocean", "ocean"]


def test_first_pack_wins_and_kinds_must_agree(spark):
    a = spark.createDataFrame([(1, 1, 10, "terrain")], "tile_lat int, tile_lon int, size int, kind string")
    b = spark.createDataFrame([(1, 1, 20, "terrain"), (2, 2, 30, "terrain")], a.schema)
    assert sorted(r.size for r in pack.merge_packs(a, b).collect()) == [10, 30]
    with pytest.raises(ValueError):
        pack.merge_packs(a, b.withColumn("kind", F.lit("population")))


def test_tile_list_slices_what_is_left(spark, tmp_path):
    (tmp_path / "cells.lst").write_text("  -71\t-33\textra\n139,  35\n#139,36\n,,\n-0,-90 , 4.5\n18.5,4\n\t\n-180\t89\n7\n")

    def cells(**some):
        return [(r.tile_lon, r.tile_lat) for r in files.read_tile_list(spark, str(tmp_path / "cells.lst"), **some).collect()]

    every = [(-71, -33), (139, 35), (0, -90), (-180, 89)]
    assert cells() == every and cells(start=3) == every[3:] and cells(limit=1) == every[:1]
    assert cells(start=4) == cells(start=40, limit=2) == [] and cells(start=2, limit=9) == every[2:]


def test_geojson_forms(spark, tmp_path):
    text = """{"type": "FeatureCollection", "features": [
      {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [4, 0], [4, 2], [0, 0]], [[1, 1], [2, 1], [1, 2]]]}},
      {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[10, 10], [12, 10], [11, 13]]], [[[-5, -5], [-4, -5], [-4, -4]]]]}},
      {"type": "Feature", "geometry": {"type": "Point", "coordinates": [99, 99]}},
      {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[50, 50], [60, 60]]]}},
      {"type": "Feature", "geometry": null}]}"""
    (tmp_path / "a.json").write_text(text)
    rings = files.read_geojson_rings(spark, str(tmp_path / "a.json"))
    assert rings.count() == 3
    e = files.geojson_extent(rings).first()
    assert (round(e.west, 6), round(e.north, 6)) == (-5 - 17 * 0.02, 13 + 18 * 0.02)
    assert files.read_geojson_rings(spark, str(tmp_path / "a.json"), max_features=1).count() == 1


def test_cities_from_arrays(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"n": "a", "la": 1.5, "lo": 2, "p": 3}, {"name": "b", "la": 1, "lo": 1}, {"n": "zero", "la": 0, "lo": 0}]')
    assert sorted(r.n for r in files.read_cities(spark, str(tmp_path / "c.json")).collect()) == ["a", "b"]


def test_sparse_index_is_not_trusted(spark):
    tiles = spark.createDataFrame([(0, 0, 5, 5)], "tile_lat int, tile_lon int, terrain_bytes int, pop_bytes int")
    land = spark.createDataFrame([(1, 1)], "tile_lat int, tile_lon int")
    assert not select.likely_ocean(tiles, land).first().is_ocean
    assert select.likely_ocean(tiles, land, trusted=True).first().is_ocean
    assert pack.fix_ocean(tiles, land).first().terrain_bytes == 5
    assert tuple(pack.fix_ocean(tiles, land, force=True).first())[2:] == (1, 1)


def test_boxes_in_either_order_and_empty(spark):
    boxes = spark.createDataFrame([(1, 2.5, 0.5, 10.0, 11.5), (2, 3.0, 3.0, 5.0, 5.0)], "id int, lat_min double, lat_max double, lon_min double, lon_max double")
    assert bbox_tiles(boxes).groupBy("id").count().collect()[0]["count"] == 6
    with pytest.raises(ValueError):
        split_tiles(boxes, 0, 3)


def plain_cells(box, wider):
    south, north, west, east = box
    return {(a, b) for a in range(max(-90, math.floor(south)), min(90, math.ceil(north) + wider)) for b in range(max(-180, math.floor(west)), min(180, math.ceil(east) + wider))}


def test_boxes_of_any_size_are_a_handful_of_blocks(spark):
    random = np.random.default_rng(10)
    boxes = [(-90.0, 90.0, -180.0, 180.0), (-0.5, 0.5, -180.0, 180.0), (0.0, 0.0, 0.0, 0.0), (89.2, 89.9, 179.1, 180.0), (91.0, 95.0, 0.0, 3.0)]
    for _ in range(30):
        la, lo = random.uniform(-95, 95), random.uniform(-185, 185)
        boxes.append((la, la + random.exponential(15), lo, lo + random.exponential(30)))
    fields = "item_id int, lat_min double, lat_max double, lon_min double, lon_max double"
    df = spark.createDataFrame([(i, *b) for i, b in enumerate(boxes)], fields)
    covers = grids.box_keys(df, F.floor("lat_min"), F.ceil("lat_max"), F.floor("lon_min"), F.ceil("lon_max"))
    rows = {r.item_id: r["count"] for r in covers.groupBy("item_id").count().collect()}
    assert max(rows.values()) <= 25 and rows[0] <= 8 and 2 not in rows and 4 not in rows
    assert {tuple(r) for r in grids.cells_of_footprint(df.filter("item_id > 1")).collect()} == set().union(*(plain_cells(b, 1) for b in boxes[2:]))
    assert grids.cells_of_footprint(df).count() == 64_800 and grids.cells_of_footprint(df.limit(0)).count() == 0
    tiles = spark.createDataFrame([(a, b) for a in range(-90, 90, 7) for b in range(-180, 180, 9)], "tile_lat int, tile_lon int")
    some = df.filter("item_id > 2")
    best = {}
    for i, (south, north, west, east) in list(enumerate(boxes))[3:]:
        for a in range(-90, 90, 7):
            for b in range(-180, 180, 9):
                high, wide = min(north, a + 1) - max(south, a), min(east, b + 1) - max(west, b)
                if high > 0 and wide > 0 and (high * wide, -i) > best.get((a, b), (0, 0)):
                    best[a, b] = high * wide, -i
    assert {(r.tile_lat, r.tile_lon): (r.area, -r.item_id) for r in select.best_footprint(tiles, some).collect()} == best


def test_rebake_rounds_stop_when_nothing_is_new(spark):
    cells = spark.createDataFrame([(i, i) for i in range(5)], "tile_lat int, tile_lon int")
    done = bake.rebake_rounds(lambda _: cells, lambda c: c, rounds=4, most=2)
    assert sorted(r["count"] for r in done.groupBy("round").count().collect()) == [1, 2, 2]


def test_rebake_rounds_say_which_cells_are_left(spark):
    cells = spark.createDataFrame([(i, i) for i in range(5)], "tile_lat int, tile_lon int")
    rows = bake.rebake_rounds(lambda _: cells, lambda c: c.withColumn("status", F.lit("ok")), rounds=2, most=2).orderBy("tile_lat").collect()
    assert [(r.tile_lat, r.status, r.round) for r in rows] == [(0, "ok", 1), (1, "ok", 1), (2, "ok", 2), (3, "ok", 2), (4, None, None)]
    assert bake.rebake_rounds(lambda _: cells, lambda c: c, rounds=None, most=1).count() == 5
    assert bake.rebake_rounds(lambda _: cells.limit(0), lambda c: c.withColumn("status", F.lit("ok"))).count() == 0


def test_rebaked_tiles_take_the_place_of_old_ones(spark, baked):
    fused, tiles = baked
    linear = bake.linear_tiles(fused, 32)
    read = bake.linear_baked(tiles, 32)
    assert read.select(linear.columns).exceptAll(linear).count() == 0 and read.count() == linear.count() > 0
    some = bake.linear_baked(tiles.filter("tile_id % 3 = 0"), 32)
    changed = bake.replaced(linear.withColumn("extra", F.lit(1)), some)
    assert changed.select(linear.columns).exceptAll(linear).count() == 0 and changed.count() == linear.count()


def test_binary_search_finds_the_leaf_of_every_block(spark, baked):
    linear = bake.linear_tiles(baked[0], 32).filter("not is_water").limit(4)
    places = linear.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(255))))
    last = F.aggregate("t_leaves", F.lit(None).cast("int"), lambda acc, x: F.when(x["begin"] <= F.col("at"), x["code"]).otherwise(acc))
    assert places.count() == 1024 and places.filter(lookup.leaf_code(F.col("t_leaves"), F.col("at")) != last).count() == 0
    assert spark.range(1).select(lookup.leaf_code(F.expr("cast(array() as array<struct<begin:int,code:int>>)"), F.lit(3)).alias("x")).first().x is None


def test_mismatch_audits_by_hand(spark):
    """Tiles of four blocks, of which one is water with people: elevation 5, density by block."""
    def code(zone):
        return codes.LEAF | 5 << 4 | zone

    def people(value, urban=0):
        return codes.LEAF | int(np.log1p(value) * codes.LOG_SCALE) << 3 | urban

    def tile(lat, zones, values):
        return (lat, 7, False, [(64 * i, code(z)) for i, z in enumerate(zones)], [(64 * i, people(*v)) for i, v in enumerate(values)])

    fields = "tile_lat int, tile_lon int, is_water boolean, t_leaves array<struct<begin:int,code:int>>, p_leaves array<struct<begin:int,code:int>>"
    rows = [tile(1, (1, 1, 1, 1), [(40, 1)] * 4), tile(2, (0, 1, 1, 0), [(3,), (40, 1), (0,), (900, 2)]), tile(3, (0, 0, 0, 0), [(0,)] * 4), (4, 7, True, None, None)]
    linear = spark.createDataFrame(rows, fields)
    samples = audit.tile_samples(linear, 4)  # four in each block
    assert samples.count() == 64 and samples.filter("tile_lat = 4 and zone = 0 and density = 0").count() == 16
    assert [tuple(r) for r in audit.water_pop_mismatch(samples, 2).orderBy("tile_lat").collect()] == [(2, 7, 8, 900)]
    assert [tuple(r) for r in audit.water_pop_mismatch(samples, 100).collect()] == [(2, 7, 4, 900)]
    assert [tuple(r) for r in audit.urban_pop_mismatch(samples, 2).collect()] == [(2, 7, 4, 900)]
    cities = spark.createDataFrame([(1, "b", 2.5, 7.5, 0.0), (2, "a", 2.1, 7.9, 0.0), (3, "c", 1.5, 7.5, 0.0), (4, "d", 3.5, 7.5, 0.0), (5, None, 2.6, 7.2, 0.0)], "city_id int, n string, la double, lo double, p double")
    middle = audit.coastal_problem_tiles(cities, linear.withColumn("t_leaves", F.when(F.col("tile_lat") == 2, F.transform("t_leaves", lambda x: F.struct(x["begin"].alias("begin"), F.lit(code(0)).alias("code")))).otherwise(F.col("t_leaves"))), 10)
    assert [tuple(r) for r in middle.collect()] == [(2, 7, "?,a,b")]
    assert audit.coastal_problem_tiles(cities, linear, 10).count() == 0


def test_rebake_query_scans_what_it_has_baked(spark, monkeypatch):
    from terraloom.plans import queries

    scans, scan = [], queries.audit.scan_problem_tiles

    def kept(samples, land):
        found = scan(samples, land)
        scans.append({(r.tile_lat, r.tile_lon) for r in found.collect()})
        return found

    monkeypatch.setattr(queries.audit, "scan_problem_tiles", kept)
    rows = queries.rebake_rounds(spark, DATA).collect()
    assert len(scans) == 2 and {(r.tile_lat, r.tile_lon) for r in rows} == scans[0] and len(rows) == len(scans[0]) > 0
    assert {r["round"] for r in rows} == {1} and scans[1] <= scans[0]


def test_linear_resampling_keeps_corners_and_zeros_missing(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 2.0, 3.0]), (2, None)], "tile_id long, v array<double>")
    rows = {r.tile_id: r.v for r in pixels.resample_layer(df, "v", 3).collect()}
    assert rows[1] == [0, 0.5, 1, 1, 1.5, 2, 2, 2.5, 3] and rows[2] == [0.0] * 9


def test_manifest_tells_packed_tiles(spark):
    tiles = spark.createDataFrame([(0, 0, 10, 10), (0, 1, 4, 9), (50, 50, 7, 7)], "tile_lat int, tile_lon int, terrain_bytes int, raw int")
    entries = pack.pack_shards(tiles, raw="raw")
    assert sorted((r.data_bytes, r.raw_bytes) for r in entries.collect()) == [(7, 7), (14, 19)]
    assert tuple(pack.shard_manifest(entries).first())[5:10] == ("zstd-per-tile", 2, 3, 21, 26)
    assert pack.shard_manifest(pack.pack_shards(tiles)).first().compression == "none"
    assert pack.shard_manifest(entries.limit(0)).first()[5:8] == ("none", 0, 0)
    head = bytes(pack.shard_chunks(tiles.withColumn("payload", F.lit(b"abcd")), raw="raw").filter("seq = 0").orderBy("path").first().chunk)
    assert struct.unpack(pack.SHARD_HEADER, head[: pack.SHARD_HEADER_BYTES])[-2:] == (19, 1)


def files_below(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_a_round_rewrites_touched_shards_alone(spark, tmp_path):
    path = tmp_path / "table"
    cells = spark.createDataFrame([(a, b, a * 1000 + b) for a in (-45, 3, 7, 61) for b in (-170, 12, 15)], "tile_lat int, tile_lon int, v int")
    tables.write_tiles(cells, str(path))
    before = files_below(path)
    new = spark.createDataFrame([(3, 12, -1), (5, 18, -2)], "tile_lat int, tile_lon int, v int")
    assert tables.replace_tiles(spark, str(path), new) == 1
    after = files_below(path)
    changed = {p.rsplit("/", 1)[0] for p in before.keys() ^ after.keys()}
    assert changed == {"shard_lat=0/shard_lon=10"} and all(after[p] == t for p, t in before.items() if not p.startswith("shard_lat=0/shard_lon=10"))
    want = {(r.tile_lat, r.tile_lon): r.v for r in cells.collect()} | {(3, 12): -1, (5, 18): -2}
    assert {(r.tile_lat, r.tile_lon): r.v for r in tables.read_tiles(spark, str(path), cells).collect()} == want
    assert tables.replace_tiles(spark, str(path), new.limit(0)) == 0


def test_a_failed_round_leaves_the_old_rows(spark, tmp_path):
    path = tmp_path / "table"
    cells = spark.createDataFrame([(1, 1, 1), (2, 2, 2), (50, 50, 3)], "tile_lat int, tile_lon int, v int")
    tables.write_tiles(cells, str(path))
    before = files_below(path)
    broken = spark.createDataFrame([(1, 1), (50, 50)], "tile_lat int, tile_lon int").withColumn("v", F.when(F.col("tile_lat") > 40, F.raise_error(F.lit("lost")).cast("int")).otherwise(7))
    with pytest.raises(Exception, match="lost"):
        tables.replace_tiles(spark, str(path), broken)
    assert files_below(path) == before
    assert sorted(r.v for r in tables.read_tiles(spark, str(path), cells).collect()) == [1, 2, 3]


def run_log(spark, first, last):
    return spark.range(first, last).selectExpr("id idx", "1 tile_lat", "2 tile_lon", "case when id % 3 = 0 then 'ok' else 'water' end status", "id nodes", "id download_ms", "id quadtree_ms")


def test_stream_tallies_equal_batch_after_a_stop(spark, tmp_path):
    log, out, read = (str(tmp_path / n) for n in ("log", "out", "read"))
    files.write_bake_log(run_log(spark, 0, 100).repartition(5), log)
    done = []

    def stop(batch):
        done.append(batch)
        if batch == 2:
            raise RuntimeError("stopped")

    with pytest.raises(Exception, match="stopped"):
        run_tallies(spark, log, out, read, files_per_batch=1, before_batch=stop)
    assert done == [0, 1, 2] and tallies(spark, out).agg(F.sum("tiles")).first()[0] == 40
    again = run_tallies(spark, log, out, read, files_per_batch=1, before_batch=done.append)
    assert done == [0, 1, 2, 2, 3, 4]
    batch = status_counts(files.read_bake_log(spark, log))
    assert again.exceptAll(batch).count() == 0 and again.count() == 2
    # files that come later are added; a run with nothing new changes nothing
    files.write_bake_log(run_log(spark, 100, 130).repartition(2), log)
    for _ in range(2):
        later = run_tallies(spark, log, out, read)
        assert later.exceptAll(status_counts(files.read_bake_log(spark, log))).count() == 0 and later.agg(F.sum("tiles")).first()[0] == 130
