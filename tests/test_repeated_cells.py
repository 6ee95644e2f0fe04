"""Tables so large that cells have several tiles: the orders and parts of the smallest tables, dealt over repeated cells."""

import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from terraloom.functions import codes
from terraloom.operators import audit, bake, grids, pack, pixels, tree
from terraloom.plans import fixtures, queries
from terraloom.plans.oracle import oracle_sql
from terraloom.plans.queries import QUERIES
from test_oracle import DATA, plain

#: A table's key and the distance at which its rows have the same cell again.
REPEATED = {"part": ("p_partkey", 64_800), "orders": ("o_orderkey", 64_800 * 64)}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("repeated")
    con = duckdb.connect()
    for name in ("customer", "supplier", "part", "orders"):
        source = f"SELECT * FROM read_parquet('{DATA}/{name}.parquet')"
        if name in REPEATED:
            key, step = REPEATED[name]
            source = f"SELECT t.* REPLACE ({key} + i * {step} AS {key}) FROM ({source}) t CROSS JOIN range(3) AS r(i)"
        con.execute(f"COPY ({source}) TO '{folder}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con, str(folder)


def same_rows(spark, tables, name):
    con, folder = tables
    df = QUERIES[name](spark, folder)
    names = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*(f"`{n}`" for n in names)).collect())
    found = con.execute(oracle_sql()[name])
    at = [[c[0] for c in found.description].index(n) for n in names]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall()) != []


@pytest.mark.parametrize("name", ["pair_tiles", "decode_tiles", "point_query_terrain", "point_query_population", "heat_map_query", "panel_query", "scan_problem_tiles", "top_mismatches", "density_p99", "sample_grid_query", "city_status_counts", "city_mismatch", "rebake_rounds", "incremental_payloads"])
def test_same_rows_where_cells_repeat(spark, tables, name):
    same_rows(spark, tables, name)


def test_rounds_count_tiles_and_take_those_of_a_cell_by_id(spark):
    rows = [(i, i % 2, 7) for i in range(6)]
    tiles = spark.createDataFrame(rows, "tile_id long, tile_lat int, tile_lon int")
    done = bake.rebake_rounds(lambda _: tiles, lambda t: t, rounds=None, most=2, key=["tile_id", "tile_lat", "tile_lon"])
    assert sorted((r["round"], r.tile_id) for r in done.collect()) == [(1, 0), (1, 2), (2, 1), (2, 4), (3, 3), (3, 5)]


def test_order_of_rows_does_not_change_layout_or_shares(spark):
    rows = [(i, i % 3, 7, 10 * (i * 7 % 12)) for i in range(12)]
    made = [spark.createDataFrame(r, "tile_id long, tile_lat int, tile_lon int, terrain_bytes long").coalesce(1) for r in (rows, rows[::-1])]
    assert len({tuple(sorted(map(tuple, pack.pack_layout(m).collect()))) for m in made}) == 1
    assert len({tuple(sorted(map(tuple, grids.split_tiles(m, 2, 5).collect()))) for m in made}) == 1
    laid = sorted(pack.pack_layout(made[0]).collect(), key=lambda r: (r.offset, r["size"]))
    assert [r.offset for r in laid] == [sum(x["size"] for x in laid[:i]) for i in range(12)]


def test_heights_of_codes_read_the_code_once_a_piece(spark):
    rows = [(None,), (-5,), (0,), *((x,) for x in range(1, 2048)), (3000,)]
    got = [r.x for r in spark.createDataFrame(rows, "code int").coalesce(1).select(codes.decode_elevation(F.col("code")).alias("x")).collect()]
    want = [next(h + (s - first) * step for h, first, step in reversed(codes.PIECES) if s >= first) for s in (min(2047, max(0, r[0] or 0)) for r in rows)]
    assert got == [None, *want[1:]]
    assert str(codes.decode_elevation(F.col("code"))).count("code") <= 1 + len(codes.PIECES)


@pytest.mark.parametrize("name", ["read_tile_dir", "read_pack_tiles", "read_pack_source"])
def test_each_tile_of_a_cell_has_its_own_file_or_entry(spark, tables, name):
    same_rows(spark, tables, name)


@pytest.mark.parametrize("name", ["validate_payloads", "bake_tiles", "budget_cuts", "overview_query", "deep_tree_sizes"])
def test_same_rows_of_jobs_on_many_tiles(spark, tables, name):
    same_rows(spark, tables, name)


def test_shards_order_tiles_of_a_cell_by_size_and_point_at_the_longest(spark):
    cells = [(0, 1, b"cccc"), (0, 0, b"bbbbb"), (0, 0, b"a"), (0, 0, b"bbbba"), (0, 2, b"dd")]
    made = []
    for rows in (cells, cells[::-1]):
        tiles = spark.createDataFrame([(a, b, bytearray(p)) for a, b, p in rows], "tile_lat int, tile_lon int, payload binary").coalesce(1)
        made.append([(r.seq, r.at, bytes(r.chunk)) for r in pack.shard_chunks(tiles, chunk_bytes=1).orderBy("seq").collect()])
    assert made[0] == made[1] and [c for _, _, c in made[0][1:]] == [b"a", b"bbbba", b"bbbbb", b"cccc", b"dd"]
    assert struct.unpack_from(pack.SHARD_ENTRY, made[0][0][2], pack.SHARD_HEADER_BYTES) == (6, 5)


def test_partitions_of_tiles_grow_with_the_table(spark, tables, monkeypatch):
    """Every step that holds tiles has so many partitions, whatever Spark makes of other shuffles."""
    _, folder = tables
    assert fixtures.pixel_parts(spark, folder) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(fixtures, "TASK_PIXELS", 1 << 13)
    parts = fixtures.pixel_parts(spark, folder)
    assert parts == 9 and int(spark.conf.get("spark.sql.shuffle.partitions")) < parts
    fused = bake.fused_tiles(fixtures.dealt_view(spark, folder, "px", parts), queries.SIDE, parts=parts)
    ok = pixels.dealt(fused.filter("status = 'ok'"), parts)
    held = [fused, bake.grown_trees(fused, queries.SIDE, parts=parts), bake.linear_tiles(fused, queries.SIDE, parts), tree.population_leaves(queries.array_pyramid(ok)), queries._deep_pyramid(spark, folder)]
    assert [df.rdd.getNumPartitions() for df in held] == [parts] * 5


def test_a_heat_map_point_meets_each_layer_by_the_cell(spark):
    """Two tiles with data in a cell: a row for each of them, with each terrain leaf and each population leaf."""
    def leaves(code):
        return [(0, codes.LEAF | code)]

    fields = "tile_id long, tile_lat int, tile_lon int, is_water boolean, t_leaves array<struct<begin:int,code:int>>, p_leaves array<struct<begin:int,code:int>>"
    linear = spark.createDataFrame([(1, 3, 7, False, leaves(5 << 4 | 1), leaves(0)), (2, 3, 7, False, leaves(9 << 4 | 2), leaves(1))], fields)
    points = spark.createDataFrame([(1, 3.5, 7.5), (2, 4.5, 7.5)], "item_id int, la double, lo double")
    found = sorted(map(tuple, audit.grid_samples(points, linear).select("item_id", "elevation", "urban").collect()), key=str)
    assert found == sorted([(1, e, u) for e in (5, 9) for u in (0, 1)] * 2 + [(2, None, None)], key=str)


def test_leaves_of_an_archive_are_never_broadcast(spark):
    """However small the files of the leaves are, a task holds those of its own cells only."""
    fields = "tile_id long, tile_lat int, tile_lon int, is_water boolean, t_leaves array<struct<begin:int,code:int>>, p_leaves array<struct<begin:int,code:int>>"
    linear = spark.createDataFrame([(1, 3, 7, False, [(0, codes.LEAF | 5 << 4 | 1)], [(0, codes.LEAF)])], fields)
    cities = spark.createDataFrame([(1, "a", 3.5, 7.5, 5.0), (2, "b", 4.5, 7.5, 5.0)], "city_id long, n string, la double, lo double, p double")
    for found in (audit.city_mismatch(cities, linear, 0), audit.verify_cities(cities, linear), audit.grid_samples(cities, linear)):
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_coastal_cells_are_broadcast_and_cities_are_not(spark):
    """Cells are bounded by the grid, cities by nothing."""
    fields = "tile_id long, tile_lat int, tile_lon int, is_water boolean, t_leaves array<struct<begin:int,code:int>>, p_leaves array<struct<begin:int,code:int>>"
    linear = spark.createDataFrame([(i, i % 90, i, False, [(0, codes.LEAF)], [(0, codes.LEAF | 4000 << 3)]) for i in range(170)], fields)
    cities = spark.createDataFrame([(1, "a", 3.5, 3.5, 5.0), (2, "b", 4.5, 4.5, 5.0), (3, "c", 4.2, 4.2, 5.0), (4, "d", 4.5, 3.5, 5.0)], "city_id long, n string, la double, lo double, p double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = audit.coastal_problem_tiles(cities, linear)
        assert sorted(map(tuple, found.collect())) == [(3, 3, "a"), (4, 4, "b,c")]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("BroadcastExchange") == 1 and "city_id" not in plan[plan.index("BroadcastExchange") :]


def test_a_panel_keeps_points_of_both_layers_only(spark):
    """Two tiles with data in a cell, as in the map above; a point without a tile is left out."""
    fields = "tile_id long, tile_lat int, tile_lon int, is_water boolean, t_leaves array<struct<begin:int,code:int>>, p_leaves array<struct<begin:int,code:int>>"
    tiles = [(k, 3, 7, False, [(0, codes.LEAF | e << 4 | 1)], [(0, codes.LEAF | u)]) for k, e, u in ((1, 5, 0), (2, 9, 1))]
    points = spark.createDataFrame([(1, 3.5, 7.5), (2, 4.5, 7.5)], "item_id int, la double, lo double")
    found = audit.grid_samples(points, spark.createDataFrame(tiles, fields), both=True).select("item_id", "elevation", "urban")
    assert sorted(map(tuple, found.collect())) == sorted([(1, e, u) for e in (5, 9) for u in (0, 1)] * 2)


def test_rounds_of_one_scan_are_baked_together(spark, tables, monkeypatch):
    """However many rounds a list needs, tiles are scanned twice, and the rounds are those of the SQL."""
    con, folder = tables
    scans, scan, rounds = [], audit.scan_problem_tiles, bake.rebake_rounds
    monkeypatch.setattr(audit, "scan_problem_tiles", lambda *a: scans.append(1) or scan(*a))
    monkeypatch.setattr(bake, "rebake_rounds", lambda *a, **k: rounds(*a, **k, most=4))
    got = sorted((r.tile_lat, r.tile_lon, r["round"]) for r in QUERIES["rebake_rounds"](spark, folder).collect())
    sql = oracle_sql()["rebake_rounds"].replace("// 2000", "// 4")
    assert got == sorted(con.execute(f"SELECT tile_lat, tile_lon, round FROM ({sql})").fetchall()) and max(r for *_, r in got) > 2 == len(scans)


@pytest.mark.parametrize("at_once", [1, 2, None])
@pytest.mark.parametrize("rounds", [2, None])
def test_rounds_are_the_same_however_many_are_baked_at_once(spark, rounds, at_once):
    key = ["tile_id", "tile_lat", "tile_lon"]
    tiles = spark.createDataFrame([(i, i % 2, -7 if i < 3 else -70) for i in range(7)], "tile_id long, tile_lat int, tile_lon int")
    calls = []
    done = bake.rebake_rounds(lambda k: calls.append(k) or tiles, lambda t: t.withColumn("status", F.lit("ok")), rounds=rounds, most=2, key=key, at_once=at_once)
    want = [(1, 4, "ok"), (1, 6, "ok"), (2, 3, "ok"), (2, 5, "ok"), (3, 0, "ok"), (3, 2, "ok"), (4, 1, "ok")]
    assert sorted(((r["round"], r.tile_id, r.status) for r in done.collect()), key=str) == sorted([(None, i, None) if rounds and k > rounds else (k, i, s) for k, i, s in want], key=str)
    assert calls == {(2, 1): [1, 2], (None, 1): [1, 2, 3, 4, 5], (None, 2): [1, 3, 5], (None, None): [1, 5]}.get((rounds, at_once), [1])
