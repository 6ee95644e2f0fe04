"""Tile-level jobs: budgeted trees to payload bytes, their checks, and rebaking rounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import codes
from ..functions.keys import file_name
from ..functions.codes import GRADIENT_LIMITS, LEAF, LOG_MAX, LOG_SCALE
from ..sources.storage import shared_folder
from .forest import grown, leaf_rows, linear_leaves, linear_rows, node_rows, payload_errors, with_cuts
from .grids import running_starts
from .pixels import KEYS, bake_status, dealt, exploded, pixel_gradient, tile_facts
from .select import CELL, likely_ocean, tile_key_of
from .tree import quad_pyramid

WATER = b"\xff"
GROWN = "tile_id long, tile_lat int, tile_lon int, terrain binary, population binary, terrain_nodes int, population_nodes int"


def _height_code(metres: float) -> int:
    m = max(0, min(8190, int(metres)))
    for low, first, step in ((3584, 1536, 8), (1536, 1024, 4), (512, 512, 2)):
        if m >= low:
            return min(2047, first + (m - low) // step)
    return m


class Pyramid:
    """Statistics of all square blocks of a tile by level, summed from two-pixel blocks up."""

    def __init__(self, dem: np.ndarray, zone: np.ndarray, pop: np.ndarray, urban: np.ndarray):
        grad = np.zeros(dem.shape)
        for axis in (0, 1):
            step, low, high = np.abs(np.diff(dem, axis=axis)), [slice(None)] * 2, [slice(None)] * 2
            low[axis], high[axis] = slice(None, -1), slice(1, None)
            for side in (tuple(low), tuple(high)):
                grad[side] = np.maximum(grad[side], step)
        sums = {"n": np.ones(dem.shape), "s": dem, "ss": dem * dem, "ps": pop, "pss": pop * pop} | {f"z{i}": (zone == i) * 1.0 for i in range(4)} | {f"u{i}": (urban == i) * 1.0 for i in range(8)}
        tops = {"low": -dem, "high": dem, "most": pop, "grad": grad}
        at = {k: (v.astype(float), np.add) for k, v in sums.items()} | {k: (v.astype(float), np.maximum) for k, v in tops.items()}
        self.levels: list[dict[str, np.ndarray]] = []
        while True:
            at = {k: (f(f(v[0::2, 0::2], v[0::2, 1::2]), f(v[1::2, 0::2], v[1::2, 1::2])), f) for k, (v, f) in at.items()}
            self.levels.insert(0, {k: v for k, (v, _) in at.items()} | {"low": -at["low"][0]})
            if self.levels[0]["n"].shape[0] == 1:
                break

    def split_maps(self, terrain: bool) -> list[np.ndarray]:
        """Per level, which blocks the rules divide, the budget apart."""
        out = []
        for level, b in enumerate(self.levels):
            parent = level - 1
            if terrain:
                mean = b["s"] / b["n"]
                spread, error = b["ss"] / b["n"] - mean * mean, np.maximum(abs(b["low"] - mean), abs(b["high"] - mean))
                zones = np.maximum.reduce([b[f"z{i}"] for i in range(4)])
                mixed = (zones < b["n"]) & ((b["n"] - zones) / b["n"] >= 0.02)
                rough, rougher = (spread >= 1) | (error >= 4), (spread >= 5) | (error >= 4)
                rule = np.where(b["z0"] == b["n"], (b["most"] > 10) & rough, np.where(b["z0"] > 0, mixed | rougher, mixed | rough))
                out.append(np.ones_like(rule, bool) if parent < 2 else rule & (parent < 9))
            else:
                mean = b["ps"] / b["n"]
                kinds = sum((b[f"u{i}"] > 0) * 1 for i in range(1, 8))
                rule = (kinds > 1) | (b["most"] >= np.maximum(3 * mean, mean + 25)) | (b["pss"] / b["n"] - mean * mean >= 16)
                out.append((np.ones_like(rule, bool) if parent < 3 else rule) & (b["most"] > 1) & (parent < 9))
        return out

    def leaf(self, level: int, r: int, c: int, terrain: bool) -> int:
        b = {k: v[r, c] for k, v in self.levels[level].items()}
        if terrain:
            mean, zone = b["s"] / b["n"], int(np.argmax([b[f"z{i}"] for i in range(4)]))
            zone = 1 if zone == 0 and (mean > 0 or b["most"] > 10) else zone
            return LEAF | _height_code(mean) << 4 | sum(b["grad"] >= g for g in GRADIENT_LIMITS) << 2 | zone
        mean, urban = b["ps"] / b["n"], int(np.argmax([b[f"u{i}"] for i in range(8)]))
        urban = urban or (2 if mean > 5000 else 1 if mean > 10 else 0)
        code = 0 if mean <= 0 else max(1, min(LOG_MAX, int(np.log1p(mean) * LOG_SCALE)))
        return LEAF | code << 3 | urban


def tree(pyramid: Pyramid, terrain: bool, budget: int) -> bytes:
    """Pre-order nodes of a tree within a budget.

    A block shares what it has among its children in order: a child that divides gets an even
    part of what the children still to come don't need, and leaves what it doesn't use.
    """
    splits, nodes, last = pyramid.split_maps(terrain), [], len(pyramid.levels) - 1

    def grow(level: int, r: int, c: int, have: int) -> int:
        if level >= last or have < 5:
            nodes.append(pyramid.leaf(level, r, c, terrain))
            return 1
        place, used = len(nodes), 1
        nodes.append(0)
        children = [(2 * r, 2 * c), (2 * r, 2 * c + 1), (2 * r + 1, 2 * c), (2 * r + 1, 2 * c + 1)]
        wants, left = [bool(splits[level + 1][x]) and have > 1 for x in children], have - 1
        for i, child in enumerate(children):
            part = min(1 + max(0, left - (4 - i)) // max(1, sum(wants[i:])), left - (3 - i)) if wants[i] else 1
            n = grow(level + 1, *child, part) if wants[i] and part >= 5 else grow(level + 1, *child, 1)
            used, left = used + n, left - n
        nodes[place] = used
        return used

    grow(0, 0, 0, min(budget, 0x7FFF))
    return np.array(nodes, "<u2").tobytes()


def fused_tiles(pixels: DataFrame, size: int | None = None, land: DataFrame | None = None, no_data_water: bool = False, trusted: bool | None = None, parts: int | None = None) -> DataFrame:
    """A row per tile of raw pixels: status, and where it is ok the repaired layers as arrays in row order.

    ``land`` is the index of land cells; without it no tile is taken for ocean beforehand.
    One grouping by tile makes facts, status and arrays. With ``size`` only whole tiles. Pixels
    are dealt into ``parts`` (None: as many as Spark makes of any shuffle), here and below.
    """
    facts = tile_facts(pixels, size, arrays=True, parts=parts)
    ocean = None if land is None else F.col("is_ocean")
    judged = bake_status(facts if land is None else likely_ocean(facts, land, trusted), ocean, no_data_water)
    return judged.select(*KEYS, "status", *(F.when(F.col("status") == "ok", F.col(f"cells.{k}")).alias(k) for k in ("dem", "pop", "zone", "urban")))


def _budgets(terrain_cap: int, population_cap: int) -> dict[str, Column]:
    people, zones = F.array_max("pop"), F.size(F.array_distinct("zone"))
    return {
        "t_budget": F.when((zones > 1) | (people > 50), terrain_cap).otherwise(min(terrain_cap, 12_000)),
        "p_budget": F.when(people > 1000, population_cap).when(people > 10, min(population_cap, 12_000)).otherwise(min(population_cap, 4_000)),
    }


def grown_trees(tiles: DataFrame, side: int, terrain_cap: int = 24_000, population_cap: int = 20_000, parts: int | None = None) -> DataFrame:
    """Of tiles that are ok: both full trees (nodes, payload), their budgets, and whether a budget cuts them.

    Columns alone: gradients on arrays, node statistics from pixels up, subtrees from the lowest
    level up, budgets from the root down. Nothing is shuffled but the rows of tiles.
    """
    levels = max(1, side.bit_length() - 1)
    ok = dealt(tiles.filter("status = 'ok'"), parts)
    pyramid = quad_pyramid(exploded(pixel_gradient(ok, side), side, "dem", "pop", "zone", "urban", "grad"), levels)
    rows = node_rows(pyramid, levels).join(ok.select(*KEYS, *(v.alias(k) for k, v in _budgets(terrain_cap, population_cap).items())), KEYS)
    for t in "tp":
        rows = with_cuts(grown(rows, t, levels), t, levels, F.col(f"{t}_budget"))
    return rows.select(*KEYS, *(f"{t}_{c}" for t in "tp" for c in ("nodes", "payload", "budget", "cut")))


def bake_tiles(tiles: DataFrame, side: int, terrain_cap: int = 24_000, population_cap: int = 20_000, parts: int | None = None) -> DataFrame:
    """Payloads, node counts and status of rows of ``fused_tiles``; ``side`` is a power of two.

    Water and ocean are one byte, no_data has no payload, both have no nodes. Trees are grown in
    columns. Only tiles whose budget cuts a tree, as rules of order then decide what is
    left out, go to a helper that grows them node by node; where no budget is smaller than
    a whole tree of that side, there are none and it doesn't run.
    """
    made = grown_trees(tiles, side, terrain_cap, population_cap, parts)
    parts = [made.select(*KEYS, F.col("t_payload").alias("terrain"), F.col("p_payload").alias("population"), F.col("t_nodes").alias("terrain_nodes"), F.col("p_nodes").alias("population_nodes"), (F.col("t_cut") | F.col("p_cut")).alias("cut"))]
    if min(terrain_cap, population_cap, 4_000) < (side * side - 1) // 3:
        cut = parts[0].filter("cut").select(*KEYS)
        parts = [parts[0].filter("not cut"), _grown_by_nodes(tiles.join(cut, KEYS, "left_semi"), terrain_cap, population_cap)]
    trees = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).drop("cut")
    byte = F.when(F.col("status").isin("water", "ocean"), F.lit(WATER))
    rest = tiles.filter("status <> 'ok'").select(*KEYS, "status", byte.alias("terrain"), byte.alias("population"), F.lit(0).alias("terrain_nodes"), F.lit(0).alias("population_nodes"))
    return trees.withColumn("status", F.lit("ok")).select(rest.columns).unionByName(rest)


def _grown_by_nodes(tiles: DataFrame, terrain_cap: int, population_cap: int) -> DataFrame:
    """Both trees of tiles whose budget binds, a node at a time; a few tiles a batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for t in f.itertuples():
                side = round(len(t.dem) ** 0.5)
                dem, zone, pop, urban = (np.asarray(x).reshape(side, side) for x in (t.dem, t.zone, t.pop, t.urban))
                p = Pyramid(dem, zone, pop, urban)
                a, b = tree(p, True, t.t_budget), tree(p, False, t.p_budget)
                rows.append((t.tile_id, t.tile_lat, t.tile_lon, a, b, len(a) // 2, len(b) // 2))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in GROWN.split(", ")])

    return tiles.select(*KEYS, "dem", "pop", "zone", "urban", *(v.alias(k) for k, v in _budgets(terrain_cap, population_cap).items())).mapInPandas(run, GROWN)


def decode_tiles(tiles: DataFrame, payload: str, terrain: bool) -> DataFrame:
    """A row per leaf of each payload: path, code and the values that the node stores.

    Water has no leaves, nor has a damaged payload; see ``leaf_rows``. Payloads are told apart by
    tile_id where there is one, as a cell may have several.
    """
    node, key = F.col("node"), tile_key_of(tiles)
    fields = [codes.bits(node, 4, 11), codes.bits(node, 0, 2), codes.bits(node, 2, 2)] if terrain else [codes.bits(node, 3, 12), codes.bits(node, 0, 3), F.lit(None).cast("int")]
    return leaf_rows(tiles, payload, key).select(*CELL, "path", *(f.alias(n) for f, n in zip(fields, ("value", "kind", "gradient"), strict=True)))


def linear_tiles(tiles: DataFrame, side: int, parts: int | None = None) -> DataFrame:
    """Rows of ``fused_tiles`` that have data as linear quadtrees: cell, is_water, and the leaves of both trees, null for water.

    Trees are those of the rules without a budget. tile_id tells tiles of the same cell apart.
    """
    levels = max(1, side.bit_length() - 1)
    pyramid = quad_pyramid(exploded(pixel_gradient(dealt(tiles.filter("status = 'ok'"), parts), side), side, "dem", "pop", "zone", "urban", "grad"), levels)
    made = linear_rows(node_rows(pyramid, levels), levels).select(*KEYS, F.lit(False).alias("is_water"), "t_leaves", "p_leaves")
    return made.unionByName(tiles.filter("status in ('water', 'ocean')").select(*KEYS, F.lit(True).alias("is_water")), allowMissingColumns=True)


def linear_baked(baked: DataFrame, side: int, parts: int | None = None) -> DataFrame:
    """The same of rows of ``bake_tiles``, read from their payloads."""
    levels = max(1, side.bit_length() - 1)
    states = baked.filter("status <> 'no_data'").select(*KEYS, (F.col("status") != "ok").alias("is_water"))
    layers = [linear_leaves(baked, payload, KEYS, name, levels, parts) for payload, name in (("terrain", "t_leaves"), ("population", "p_leaves"))]
    return states.join(layers[0], KEYS, "left").join(layers[1], KEYS, "left")


def replaced(rows: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of tiles with new ones in place of the old; a tile (by tile_id where there is one, else cell) without a new row keeps its old one."""
    key = tile_key_of(new)
    done = F.broadcast(new.select(*key))  # a round is at most 2,000 tiles
    return rows.select(new.columns).join(done, key, "left_anti").select(new.columns).unionByName(new)


def validate_payloads(tiles: DataFrame, payload: str = "terrain") -> DataFrame:
    """Tiles with a damaged payload and the error."""
    return payload_errors(tiles.select(*CELL, payload), payload).filter("error is not null").select(*CELL, "error")


def in_rounds(tiles: DataFrame, most: int, key: list[str], first: int = 1) -> DataFrame:
    """The key and the round of each tile: ``most`` a round in order of file names, tiles of the same cell in order of their key.

    A tile's place is the number of tiles of columns of the grid whose names come before, and its place in its own.
    """
    group = F.concat(F.col("tile_lon").cast("string"), F.lit("_"))  # no other group's names come between
    order = Window.partitionBy("_group").orderBy(file_name(F.col("tile_lat"), F.col("tile_lon")), *key)
    placed = tiles.withColumn("_group", group).join(F.broadcast(running_starts(tiles, group, F.count("*"))), "_group").withColumn("_place", F.col("_start") + F.row_number().over(order) - 1)
    return placed.select(*key, (F.floor(F.col("_place") / most) + first).cast("int").alias("round"))


def rebake_rounds(scan: Callable[[int], DataFrame], bake: Callable[[DataFrame], DataFrame], rounds: int | None = 4, most: int = 2_000, key: list[str] = CELL, at_once: int | None = 1) -> DataFrame:
    """Scans, drops tiles already redone, bakes at most ``most`` a round in order of file names, and repeats.

    ``key`` tells tiles apart and has the cell. ``scan(round)`` gives problem tiles, ``bake(tiles)`` the
    rows of rebaked ones, all of them, which each further round reads again. Tiles of the same cell are
    taken in order of their key. Returns the rebaked rows with their round, none on a clean archive; ends
    when a scan finds nothing new. If ``rounds`` (None: no end) end first, each tile left
    has a row with nulls beside its key.

    ``at_once`` rounds (None: all that a scan's tiles need) go to one call of ``bake`` before the next scan.
    Where a scan judges a cell by its own tiles alone, a round changes nothing for cells of the
    others, so these are the rounds of a scan each; a cell that the end of a round parts stays
    on the list until all its tiles are redone.
    """
    done: DataFrame | None = None
    k = 1
    while rounds is None or k <= rounds:
        found = scan(k).select(*key).distinct()
        left = found if done is None else found.join(done.select(*key), key, "left_anti")
        last = min((n for n in (rounds, at_once and k + at_once - 1) if n is not None), default=None)
        listed = in_rounds(left, most, key, k)
        path = shared_folder(found.sparkSession, "rounds")  # the list stays as it is when its tiles have changed
        (listed if last is None else listed.filter(F.col("round") <= last)).write.parquet(path)
        tiles = found.sparkSession.read.schema(listed.schema).parquet(path)
        final = tiles.agg(F.max("round")).first()[0]
        if final is None:
            break
        made = bake(tiles.select(*key))
        made = made.withColumn("round", F.lit(k)) if final == k else made.join(tiles, key).select(*made.columns, "round")
        done = made if done is None else done.unionByName(made)
        k = final + 1
    else:
        if done is not None:
            left = found.join(done.select(*key), key, "left_anti")
            done = done.unionByName(left, allowMissingColumns=True)
    if done is None:
        return bake(found.limit(0)).withColumn("round", F.lit(0)).limit(0)
    return done
