"""Trees in columns against trees grown node by node, on deeper tiles than those of the views."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraloom.functions.codes import LEAF
from terraloom.operators import bake, forest, pixels

FUSED = "tile_id long, tile_lat int, tile_lon int, status string, dem array<double>, pop array<double>, zone array<int>, urban array<int>"


def ground(side):
    """(dem, pop, zone, urban) of tiles whose split rules differ: towns, noise, edges, several urban types, sea."""
    random = np.random.default_rng(side)
    y, x = np.mgrid[0:side, 0:side]
    flat, none = np.full((side, side), 40.0), np.zeros((side, side))
    town = none.copy()
    town[side // 3, side // 5] = 4_000
    dense = np.where((x // 5 + y // 7) % 3 == 0, 1_500.0, 2.0)
    sea = np.where(x < side // 3, 0, 1)
    return [
        (flat, none, none + 1, none),
        (flat, town, none + 1, none),
        (flat + random.integers(0, 9, flat.shape), dense, 1 + (x // 9 + y // 4) % 3, none),
        (flat * (1 - (sea == 0)) + random.integers(0, 3, flat.shape) * (sea > 0), none + 3, sea, (x // 11) % 4),
        (900 + 40.0 * np.abs((x + 3 * y) % 61 - 30), random.integers(0, 30, flat.shape) * 1.0, none + 2, (y // 6) % 2 * 3),
        (np.where(y < side // 2, 0.0, 260.0), np.where(x > y, 12.0, 0.0), np.where(y < side // 2, 0, 3), none),
    ]


def rows_of(side):
    tiles = ground(side)
    return [(i, i, -i, "ok", *(np.asarray(a, float).ravel().tolist() for a in t[:2]), *(np.asarray(a).astype(int).ravel().tolist() for a in t[2:])) for i, t in enumerate(tiles)]


def pyramids(side):
    return [bake.Pyramid(*(np.asarray(a, float) for a in (d, z, p, u))) for d, p, z, u in ground(side)]


@pytest.mark.parametrize("side", [4, 16, 64])
def test_full_trees_equal_those_grown_by_nodes(spark, side):
    got = {r.tile_id: r for r in bake.grown_trees(spark.createDataFrame(rows_of(side), FUSED), side).collect()}
    for i, p in enumerate(pyramids(side)):
        want = [bake.tree(p, terrain, 30_000) for terrain in (True, False)]
        assert [bytes(got[i].t_payload), bytes(got[i].p_payload)] == want
        assert [got[i].t_nodes, got[i].p_nodes] == [len(w) // 2 for w in want]
        assert not got[i].t_cut and not got[i].p_cut


@pytest.mark.parametrize("caps", [(5, 3), (22, 30), (90, 86), (300, 120), (700, 900)])
def test_cuts_are_told_and_cut_trees_are_those_of_the_budget(spark, caps):
    side, tiles = 64, spark.createDataFrame(rows_of(64), FUSED)
    cuts = {r.tile_id: r for r in bake.grown_trees(tiles, side, *caps).collect()}
    made = {r.tile_id: r for r in bake.bake_tiles(tiles, side, *caps).collect()}
    for i, p in enumerate(pyramids(side)):
        full = [bake.tree(p, terrain, 30_000) for terrain in (True, False)]
        small = [bake.tree(p, terrain, b) for terrain, b in ((True, cuts[i].t_budget), (False, cuts[i].p_budget))]
        assert [cuts[i].t_cut, cuts[i].p_cut] == [a != b for a, b in zip(full, small, strict=True)]
        assert [bytes(made[i].terrain), bytes(made[i].population)] == small
    assert len({(r.t_cut, r.p_cut) for r in cuts.values()}) > 1 or caps in ((5, 3), (22, 30))


def test_rules_decide_below_the_forced_levels(spark):
    """Sizes that only a hot spot, several urban types, or the variance of people give."""
    got = [r.p_nodes for r in bake.grown_trees(spark.createDataFrame(rows_of(64), FUSED), 64).orderBy("tile_id").collect()]
    assert got[0] == 5 and got[5] > 85  # nobody anywhere: the root's children are leaves
    # one town: the root's four, and four more on each level down to blocks of two pixels
    assert got[1] == 1 + 4 * 5
    assert got[3] > 341 and got[4] > 341


def test_leaves_cover_each_tile_and_give_their_nodes_back(spark):
    tiles = bake.grown_trees(spark.createDataFrame(rows_of(64), FUSED), 64)
    leaves = forest.leaf_rows(tiles, "t_payload", ["tile_id"])
    for i, p in enumerate(pyramids(64)):
        raw = np.frombuffer(bake.tree(p, True, 30_000), "<u2").tolist()
        waiting, want = [""], {}
        for node in raw:
            path = waiting.pop()
            if node & LEAF:
                want[path] = node
            else:
                waiting += [path + q for q in "3210"]
        assert {r.path: r.node for r in leaves.filter(F.col("tile_id") == i).collect()} == want


def plain_error(raw):
    """What is wrong with a payload, by walking it."""
    if raw is None or len(raw) <= 1:
        return None
    raw = raw[16:] if raw[:4] == b"QTR5" else raw
    if len(raw) % 2:
        return "odd byte count"
    if not raw:
        return "empty payload"
    nodes = np.frombuffer(raw, "<u2").tolist()
    if nodes[0] & LEAF:
        return "root is a leaf"
    if nodes[0] != len(nodes):
        return "structure"
    for la, lo in ((0.25, 0.25), (0.75, 0.75), (0.5, 0.5), (0.1, 0.9)):
        at = 0
        for _ in range(20):
            if at >= len(nodes) or nodes[at] & LEAF:
                break
            child = at + 1
            for _ in range((lo >= 0.5) + 2 * (la < 0.5)):
                child += 1 if child >= len(nodes) or nodes[child] & LEAF else max(1, nodes[child])
            at, la, lo = child, la % 0.5 * 2, lo % 0.5 * 2
        if at >= len(nodes) or not nodes[at] & LEAF:
            return "structure"
    return None


def damaged():
    random = np.random.default_rng(8)
    good = bake.tree(pyramids(64)[2], True, 30_000)
    out = [good, good[:-2], good[:-1], b"\xff", None, b"", b"QTR5" + bytes(12), b"QTR5" + bytes(12) + good, good[-2:], b"QTR5" + bytes(12) + good[-2:], bytes(2), bytes(4), b"\x03\x00\x01\x80\x01\x80"]
    for _ in range(60):
        nodes = np.frombuffer(good, "<u2").copy()
        at = random.integers(0, len(nodes), 3)
        nodes[at] = random.integers(0, 1 << 16, 3)
        out.append(nodes.tobytes())
    return out


def test_damage_is_named_as_by_walking(spark):
    rows = damaged()
    df = spark.createDataFrame([(i, None if r is None else bytearray(r)) for i, r in enumerate(rows)], "tile_id long, payload binary")
    got = {r.tile_id: r.error for r in forest.payload_errors(df, "payload").collect()}
    assert got == {i: plain_error(r) for i, r in enumerate(rows)}
    assert len(set(got.values())) == 5


def test_damaged_payloads_have_no_leaves(spark):
    rows = damaged()
    df = spark.createDataFrame([(i, None if r is None else bytearray(r)) for i, r in enumerate(rows)], "tile_id long, payload binary")
    leaves = {r.tile_id: r.n for r in forest.leaf_rows(df, "payload", ["tile_id"]).groupBy("tile_id").agg(F.count("*").alias("n"), F.sum(F.pow(F.lit(0.25), F.length("path"))).alias("area")).filter("area = 1").collect()}
    assert leaves[0] == leaves[7] == forest.leaf_rows(df.filter("tile_id = 0"), "payload", ["tile_id"]).count()
    assert leaves[8] == leaves[9] == 1 and not leaves.keys() & {1, 3, 4, 5, 6, 10, 11, 12}
    assert leaves.keys() == {r.tile_id for r in forest.leaf_rows(df, "payload", ["tile_id"]).select("tile_id").distinct().collect()}


@pytest.mark.parametrize("side", [1, 2, 7])
def test_gradients_of_arrays(spark, side):
    dem = np.random.default_rng(side).integers(-50, 400, (side, side)).astype(float)
    want = np.zeros(dem.shape)
    for r in range(side):
        for c in range(side):
            near = [dem[a, b] for a, b in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)) if 0 <= a < side and 0 <= b < side]
            want[r, c] = max((abs(dem[r, c] - n) for n in near), default=0)
    df = spark.createDataFrame([(1, dem.ravel().tolist()), (2, None)], "tile_id long, dem array<double>")
    got = {r.tile_id: r.grad for r in pixels.pixel_gradient(df, side).collect()}
    assert got[1] == want.ravel().tolist() and not got[2]


@pytest.mark.parametrize("sizes", [(5, 8), (8, 5), (3, 3), (1, 4), (6, 1)])
def test_resampling_is_separable_and_keeps_corners(spark, sizes):
    old, new = sizes
    grid = np.random.default_rng(old * 10 + new).integers(0, 90, (old, old)).astype(float)
    at = np.arange(new) * ((old - 1) / max(1, new - 1))
    by_rows = np.stack([np.interp(at, np.arange(old), row) for row in grid])
    want = np.stack([np.interp(at, np.arange(old), column) for column in by_rows.T]).T
    df = spark.createDataFrame([(1, grid.ravel().tolist()), (2, None)], "tile_id long, v array<double>")
    got = {r.tile_id: r.v for r in pixels.resample_layer(df, "v", new).collect()}
    assert np.allclose(np.array(got[1]).reshape(new, new), want) and got[2] == [0.0] * new * new
    near = np.floor(at + 0.5).astype(int)
    codes = df.withColumn("v", F.col("v").cast("array<int>"))
    got = {r.tile_id: r.v for r in pixels.resample_layer(codes, "v", new).collect()}
    assert got[1] == grid[np.ix_(near, near)].astype(int).ravel().tolist() and got[2] == [0] * new * new


def test_statuses_by_rule(spark):
    """Zero elevation is missing; water over 95 % of the cover makes ocean; the index of land may be passed by."""
    def tile(i, dem, esa, pop=0.0):
        return [(i, 0, i, r, c, dem, pop, 30 if esa and (r, c) == (0, 0) else esa) for r in range(8) for c in range(8)]

    rows = tile(1, 0.0, 80) + tile(2, None, 30) + tile(3, 5.0, 80) + tile(4, -3.0, 80) + tile(5, 5.0, None) + tile(6, 5.0, 80) + tile(7, None, None)
    px = spark.createDataFrame(rows, "tile_id long, tile_lat int, tile_lon int, r int, c int, dem double, pop double, esa int")
    free = {r.tile_id: r.status for r in bake.fused_tiles(px, 8).collect()}
    assert free == {1: "ocean", 2: "no_data", 3: "ok", 4: "ok", 5: "ok", 6: "ok", 7: "no_data"}
    land = spark.createDataFrame([(0, 3), (0, 4)], "tile_lat int, tile_lon int")
    judged = bake.fused_tiles(px, 8, land, trusted=True)
    assert {r.tile_id: r.status for r in judged.collect()} == {1: "ocean", 2: "no_data", 3: "ok", 4: "ok", 5: "no_data", 6: "ocean", 7: "no_data"}
    made = {r.tile_id: r for r in bake.bake_tiles(judged, 8).collect()}
    assert {i: None if r.terrain is None else bytes(r.terrain) for i, r in made.items() if r.status != "ok"} == {1: b"\xff", 2: None, 5: None, 6: b"\xff", 7: None}
    assert {r.tile_id: r.status for r in bake.fused_tiles(px, 8, no_data_water=True).collect()}[7] == "ocean"
