"""Whole quadtrees as one row per tile: payloads from node tables, what a budget cuts, and leaves from payloads.

A complete quadtree is an array in level order: the children of entry i are 4 i + 1 to 4 i + 4, in
the order NW, NE, SW, SE. Everything here is columns over such arrays; no row leaves its tile.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import codes
from .pixels import dealt
from .tree import TILE, population_codes, population_splits, terrain_codes, terrain_splits

#: Trees hold at most so many nodes, as a branch states its size in 15 bits.
MOST_NODES = 0x7FFF
#: With fewer nodes a block can't be divided.
LEAST_SPLIT = 5
#: No tree is deeper; navigation gives up after so many steps.
MOST_STEPS = 20
#: Areas are counted in blocks of this level.
DEEPEST = 15
HEADER = b"QTR5"
HEADER_BYTES = 16


def level_start(level: int) -> int:
    return (4**level - 1) // 3


def _added(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that later steps read as it is, and that no rule of the optimizer copies into them."""
    kept = [c for c in rows.columns if c != name]
    return rows.select(*kept, F.inline(F.array(F.struct(value.alias(name)))))


def node_rows(pyramid: DataFrame, levels: int) -> DataFrame:
    """A row per tile with ``nodes``: in level order, whether each block is divided and its code as a leaf, for both trees.

    ``pyramid`` has all blocks of levels 0 to ``levels`` - 1; those of the lowest are never divided.
    """
    bits = sum((F.shiftright(F.col(q), i).bitwiseAND(F.lit(1)) * (1 << (2 * i + k)) for k, q in enumerate(("qc", "qr")) for i in range(levels - 1)), F.lit(0))
    inner, root = F.col("level") < levels - 1, F.col("level") == 0
    node = F.struct("level", bits.alias("at"), (inner & (root | terrain_splits())).alias("t_split"), terrain_codes().alias("t_code"), (inner & (root | population_splits())).alias("p_split"), population_codes().alias("p_code"), terrain_splits().alias("t_wants"), population_splits().alias("p_wants"))
    return pyramid.groupBy(*TILE).agg(F.sort_array(F.collect_list(node)).alias("nodes"))


def _hex(number: Column) -> Column:
    """Little-endian 16 bits as four digits."""
    digits = F.hex(number + 0x10000)
    return F.concat(F.substring(digits, 4, 2), F.substring(digits, 2, 2))


def _level(rows: str, level: int) -> Column:
    return F.slice(rows, level_start(level) + 1, 4**level)


def grown(rows: DataFrame, tree: str, levels: int) -> DataFrame:
    """Adds the size and payload of each block's full subtree by level, from the lowest up; ``tree`` is t or p.

    A leaf is its code; a branch its size and then its four subtrees in order, so the payload of
    the whole tree is that of the root: ``{tree}_nodes`` and ``{tree}_payload``.
    """

    def leaf(n: Column) -> Column:
        return F.struct(F.lit(1).alias("size"), _hex(n[f"{tree}_code"]).alias("text"))

    def block(below: Column) -> Callable[[Column, Column], Column]:
        def made(n: Column, i: Column) -> Column:
            children = [F.get(below, 4 * i + k) for k in range(4)]
            size = 1 + sum((c["size"] for c in children[1:]), children[0]["size"])
            return F.when(n[f"{tree}_split"], F.struct(size.alias("size"), F.concat(_hex(size), *(c["text"] for c in children)).alias("text"))).otherwise(leaf(n))

        return made

    out = _added(rows, f"_{tree}{levels - 1}", F.transform(_level("nodes", levels - 1), leaf))
    for level in range(levels - 2, -1, -1):
        out = _added(out, f"_{tree}{level}", F.transform(_level("nodes", level), block(F.col(f"_{tree}{level + 1}"))))
    top = F.get(f"_{tree}0", F.lit(0))
    return out.withColumns({f"{tree}_nodes": top["size"], f"{tree}_payload": F.unhex(top["text"])})


def with_cuts(rows: DataFrame, tree: str, levels: int, budget: Column) -> DataFrame:
    """Adds ``{tree}_cut``: whether a budget of nodes cuts the tree that ``grown`` made.

    Budgets go down a level at a time. A block has its budget less one for its children; in
    order, each that divides gets an even part of what it and those to come can spare, and one that
    doesn't divide gets one. A child that divides but gets too few is cut. While none is, each
    child uses its full size, so what is left for the next is known without growing anything.
    """
    most = F.least(budget, F.lit(MOST_NODES)).cast("int")
    out = rows.withColumn(f"_{tree}_have", F.array(most)).withColumn(f"{tree}_cut", (most < LEAST_SPLIT) & F.lit(levels > 1))

    def parts(wants: Column, full: Column, last: bool) -> Callable[[Column, Column], Column]:
        def made(have: Column, i: Column) -> Column:
            want = [F.get(wants, 4 * i + k)[f"{tree}_wants"] for k in range(4)]
            used = [F.get(full, 4 * i + k)["size"] for k in range(4)]
            out = []
            for k in range(4):
                left = have - 1 - sum(used[:k], F.lit(0))
                still = sum((w.cast("int") for w in want[k + 1 :]), F.lit(1))
                share = 1 + F.floor(F.greatest(F.lit(0), left - (4 - k)) / still)
                part = F.when(want[k], F.least(share, left - (3 - k))).otherwise(1)
                cut = F.lit(False) if last else want[k] & (part < LEAST_SPLIT)
                out.append(F.struct(part.cast("int").alias("have"), cut.alias("cut")))
            return F.when(have >= LEAST_SPLIT, F.array(*out)).otherwise(F.array_repeat(F.struct(F.lit(0).alias("have"), F.lit(False).alias("cut")), 4))

        return made

    for level in range(levels - 1):
        out = _added(out, "_parts", F.flatten(F.transform(f"_{tree}_have", parts(_level("nodes", level + 1), F.col(f"_{tree}{level + 1}"), level + 1 == levels - 1))))
        out = out.withColumns({f"_{tree}_have": F.transform("_parts", lambda p: p["have"]), f"{tree}_cut": F.col(f"{tree}_cut") | F.exists("_parts", lambda p: p["cut"])})
    return out.drop("_parts", f"_{tree}_have")


def linear_rows(rows: DataFrame, levels: int) -> DataFrame:
    """Linear quadtrees: a row per tile with ``t_leaves`` and ``p_leaves``, structs of begin and code in order of begin.

    ``begin`` is the place of a leaf's first block on the curve through the 4 ** (levels - 1)
    smallest blocks. Blocks are told from the root down: one is there if all above it divide.
    """
    out = rows
    for tree in "tp":
        here, parts = F.array(F.lit(True)), []
        for level in range(levels):
            out = _added(out, f"_{tree}{level}", here)
            cells = F.zip_with(_level("nodes", level), f"_{tree}{level}", _leaf_of(tree, 4 ** (levels - 1 - level)))
            parts.append(F.filter(cells, lambda x: x.isNotNull()))
            here = F.flatten(F.zip_with(_level("nodes", level), f"_{tree}{level}", _children_of(tree)))
        out = _added(out, f"{tree}_leaves", F.array_sort(F.concat(*parts)))
    return out.select(*TILE, "t_leaves", "p_leaves")


def _leaf_of(tree: str, width: int) -> Callable[[Column, Column], Column]:
    return lambda n, p: F.when(p & ~n[f"{tree}_split"], F.struct((n["at"] * width).alias("begin"), n[f"{tree}_code"].alias("code")))


def _children_of(tree: str) -> Callable[[Column, Column], Column]:
    return lambda n, p: F.array_repeat(p & n[f"{tree}_split"], 4)


def linear_leaves(tiles: DataFrame, payload: str, key: list[str], name: str, levels: int, parts: int | None = None) -> DataFrame:
    """The leaves of payloads as one row per tile, like those of ``linear_rows``."""
    begin = F.conv(F.rpad("path", levels - 1, "0"), 4, 10).cast("int")
    return leaf_rows(tiles, payload, key, parts).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(begin.alias("begin"), F.col("node").alias("code")))).alias(name))


def payload_nodes(payload: Column) -> Column:
    """The 16-bit nodes of a payload, a header skipped; an odd byte at the end is left out."""
    bare = F.when(F.substring(payload, 1, 4) == F.lit(HEADER), F.substring(payload, F.lit(HEADER_BYTES + 1), F.length(payload))).otherwise(payload)
    text = F.hex(bare)
    at = F.when(F.length(bare) >= 2, F.sequence(F.lit(0), F.floor(F.length(bare) / 2).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.conv(F.concat(F.substring(text, 4 * i + 3, F.lit(2)), F.substring(text, 4 * i + 1, F.lit(2))), 16, 10).cast("int"))


def is_leaf(node: Column) -> Column:
    return node.bitwiseAND(F.lit(codes.LEAF)) != 0


def leaf_rows(tiles: DataFrame, payload: str, key: list[str], parts: int | None = None) -> DataFrame:
    """A row per leaf of each payload: path and node.

    Nodes are nested intervals: one at place i that is a branch of size n holds the places up to
    i + n. A running count of those begun and ended gives the level of each node, and the areas of
    the leaves before it the place on the curve through the tile, whose digits are its path.
    A payload of one byte (water) or null has no leaves. Nor has a damaged one: where the root's
    size isn't the number of nodes, or intervals don't nest into quarters. Tiles are dealt into
    ``parts`` (None: as many as Spark makes of any shuffle) before nodes become rows.
    """
    listed = _added(tiles.select(*key, payload), "_nodes", payload_nodes(F.col(payload))).filter((F.size("_nodes") > 0) & F.when(F.size("_nodes") == 1, is_leaf(F.get("_nodes", F.lit(0)))).otherwise(F.get("_nodes", F.lit(0)) == F.size("_nodes")))
    rows = dealt(listed, parts, key).select(*key, F.size("_nodes").alias("_n"), F.posexplode("_nodes").alias("_at", "_node"))
    branch = ~is_leaf(F.col("_node"))
    begun = F.struct(F.col("_at").alias("at"), F.lit(1).alias("kind"), F.when(branch, 1).otherwise(0).alias("step"))
    ended = F.struct((F.col("_at") + F.col("_node")).alias("at"), F.lit(0).alias("kind"), F.lit(-1).alias("step"))
    events = rows.select(*key, "_n", "_node", F.inline(F.when(branch, F.array(begun, ended)).otherwise(F.array(begun))))
    order = Window.partitionBy(*key).orderBy("at", "kind")
    levels = events.withColumn("_level", F.coalesce(F.sum("step").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    fine = F.col("_level").between(0, DEEPEST)
    area = F.when(fine, F.call_function("shiftleft", F.lit(1).cast("long"), (2 * (DEEPEST - F.col("_level"))).cast("int"))).otherwise(0)
    own = levels.filter("kind = 1").withColumns({"_area": area, "_leaf": is_leaf(F.col("_node"))})
    before = Window.partitionBy(*key).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("_begin", F.coalesce(F.sum(F.when(F.col("_leaf"), F.col("_area"))).over(before), F.lit(0)))
    whole = Window.partitionBy(*key)
    sound = F.min(fine & (F.col("_begin") % F.greatest("_area", F.lit(1)) == 0)).over(whole) & (F.sum(F.when(F.col("_leaf"), F.col("_area"))).over(whole) == 1 << (2 * DEEPEST))
    kept = placed.withColumn("_sound", sound).filter("_sound and _leaf")
    digits = F.lpad(F.conv(F.col("_begin").cast("string"), 10, 4), DEEPEST, "0")
    return kept.select(*key, F.substring(digits, F.lit(1), F.col("_level").cast("int")).alias("path"), F.col("_node").alias("node"))


def _probe(nodes: Column, la: float, lo: float) -> Column:
    """Whether stepping to the block of a point ends on a leaf."""
    n = F.size(nodes)

    def after(place: Column) -> Column:
        node = F.get(nodes, place)
        return place + F.when((place >= n) | is_leaf(node), 1).otherwise(F.greatest(F.lit(1), node))

    def step(at: Column, i: Column) -> Column:
        q = F.when(F.lit(lo) * F.pow(F.lit(2.0), i) % 1 >= 0.5, 1).otherwise(0) + F.when(F.lit(la) * F.pow(F.lit(2.0), i) % 1 < 0.5, 2).otherwise(0)
        first = at + 1
        second = after(first)
        third = after(second)
        child = F.when(q == 0, first).when(q == 1, second).when(q == 2, third).otherwise(after(third))
        return F.when((at >= n) | is_leaf(F.get(nodes, at)), at).otherwise(child)

    end = F.aggregate(F.sequence(F.lit(0), F.lit(MOST_STEPS - 1)), F.lit(0), step)
    return (end < n) & is_leaf(F.get(nodes, end))


def payload_errors(tiles: DataFrame, payload: str) -> DataFrame:
    """Adds error: what is wrong with a data payload; null for none, and for water or no payload."""
    raw, nodes = F.col(payload), F.col("_nodes")
    bare = F.length(raw) - F.when(F.substring(raw, 1, 4) == F.lit(HEADER), HEADER_BYTES).otherwise(0)
    root = F.get(nodes, F.lit(0))
    reached = [_probe(nodes, la, lo) for la, lo in ((0.25, 0.25), (0.75, 0.75), (0.5, 0.5), (0.1, 0.9))]
    sound = (root == F.size(nodes)) & reached[0] & reached[1] & reached[2] & reached[3]
    error = F.when(F.coalesce(F.length(raw), F.lit(0)) <= 1, None).when(bare % 2 != 0, "odd byte count").when(bare < 2, "empty payload").when(is_leaf(root), "root is a leaf").when(~sound, "structure")
    return _added(_added(tiles, "_nodes", payload_nodes(raw)), "error", error).drop("_nodes")
