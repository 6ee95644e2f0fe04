"""Column functions for cells, shards and quadrant paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

WIDTH, HEIGHT = 360, 180


def on_grid(la: Column, lo: Column) -> Column:
    """Whether a point lies in a cell; the northern and eastern edges don't."""
    return (la >= -90) & (la < 90) & (lo >= -180) & (lo < 180)


def cell(x: Column) -> Column:
    return F.floor(x).cast("int")


def fraction(x: Column) -> Column:
    return x - F.floor(x)


def tile_index(lat: Column, lon: Column) -> Column:
    return ((lat + 90) * WIDTH + lon + 180).cast("int")


def index_lat(index: Column) -> Column:
    return (F.floor(index / WIDTH) - 90).cast("int")


def index_lon(index: Column) -> Column:
    return (index % WIDTH - 180).cast("int")


def shard_origin(x: Column, low: int, degrees: int) -> Column:
    """First row or column of the shard of a cell; ``low`` is -90 or -180."""
    return (F.floor((x - low) / degrees) * degrees + low).cast("int")


def shard_size(origin: Column, top: int, degrees: int) -> Column:
    """Rows or columns of a shard, fewer at the edge; ``top`` is 90 or 180."""
    return F.least(F.lit(degrees), top - origin).cast("int")


def file_name(lat: Column, lon: Column, suffix: str = ".qtree") -> Column:
    return F.concat(lon.cast("string"), F.lit("_"), lat.cast("string"), F.lit(suffix))


def _digits(col_bits: Column, row_bits: Column, level: int) -> Column:
    """A digit 0..3 per level from the binary digits of column and row, most significant first."""
    each = [(F.shiftright(col_bits, level - 1 - i).bitwiseAND(F.lit(1)) + 2 * F.shiftright(row_bits, level - 1 - i).bitwiseAND(F.lit(1))).cast("string") for i in range(level)]
    return F.concat(*each) if each else F.lit("")


def point_path(frac_lat: Column, frac_lon: Column, level: int) -> Column:
    """Quadrant path of a point: NW 0, NE 1, SW 2, SE 3; exact, as only powers of two scale."""
    cols = F.floor(frac_lon * (1 << level)).cast("int")
    rows = ((1 << level) - 1 - F.floor(frac_lat * (1 << level))).cast("int")
    return _digits(cols, rows, level)


def block_path(row: Column, col: Column, level: int) -> Column:
    """Quadrant path of block (row, col) of a level; row 0 is north."""
    return _digits(col, row, level)


def path_number(path: Column, of: str) -> Column:
    """Column ('c') or row ('r') of a path's block in its level."""
    digits = F.transform(F.filter(F.split(path, ""), lambda d: d != ""), lambda d: d.cast("int"))
    return F.aggregate(digits, F.lit(0), lambda acc, d: acc * 2 + (d % 2 if of == "c" else F.shiftright(d, 1)))


def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)
