"""Column functions for elevations, densities, classes and node bits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the tile format.
ZONES = {0: "Water", 1: "Natural", 2: "Forest", 3: "Harsh"}
GRADIENTS = {0: "Flat", 1: "Gentle", 2: "Steep", 3: "Cliff"}
GRADIENT_LIMITS = [10, 50, 200]
URBAN = {0: "Uninhabited", 1: "Residential", 2: "Commercial", 3: "Industrial", 4: "Mixed", 5: "Institutional", 6: "Reserved", 7: "Reserved"}
FOREST_CLASSES, HARSH_CLASSES, WATER_CLASS, URBAN_CLASS = [10], [70, 90, 95], 80, 50
LOG_SCALE, LOG_MAX = 355.7, 4095
LEAF = 1 << 15
#: First height, first code and step of each piece of the elevation scale.
PIECES = [(0, 0, 1), (512, 512, 2), (1536, 1024, 4), (3584, 1536, 8)]


def encode_elevation(metres: Column) -> Column:
    """11-bit code of a height, which is clamped to 0..8190 and truncated (null: null)."""
    m = F.least(F.lit(8190), F.greatest(F.lit(0), metres.cast("int")))
    out = m
    for height, code, step in PIECES[1:]:
        out = F.when(m >= height, F.least(F.lit(2047), code + F.floor((m - height) / step))).otherwise(out)
    return F.when(metres.isNotNull(), out.cast("int"))


def decode_elevation(code: Column) -> Column:
    """Lowest height of a code; the top code is 7,672 m.

    Pieces grow steeper, so the height is the largest of all lines; ``code`` is read once for
    each, not once for each way through nested cases.
    """
    s = F.least(F.lit(2047), F.greatest(F.lit(0), code.cast("int")))
    lines = [s * step + (height - first * step) for height, first, step in PIECES]
    return F.when(code.isNotNull(), F.greatest(*lines).cast("int"))


def encode_pop_density(density: Column) -> Column:
    scaled = F.floor(F.log1p(density) * LOG_SCALE)
    code = F.when(density <= 0, 0).otherwise(F.greatest(F.lit(1), F.least(F.lit(LOG_MAX), scaled)))
    return F.when(density.isNotNull(), code).cast("int")


def decode_pop_density(code: Column) -> Column:
    density = F.when(code <= 0, 0).otherwise(F.greatest(F.lit(1.0), F.bround(F.expm1(code / LOG_SCALE))))
    return F.when(code.isNotNull(), density).cast("int")


def landcover_zone(klass: Column) -> Column:
    """Zone of a land-cover class; a missing class is Natural."""
    zone = F.when(klass.isin(FOREST_CLASSES), 2).when(klass.isin(HARSH_CLASSES), 3).when(klass == WATER_CLASS, 0)
    return F.coalesce(zone.otherwise(1), F.lit(1)).cast("int")


def landcover_urban(klass: Column) -> Column:
    return F.when(klass == URBAN_CLASS, 1).otherwise(0).cast("int")


def gradient_level(difference: Column) -> Column:
    a, b, c = GRADIENT_LIMITS
    return F.when(difference < a, 0).when(difference < b, 1).when(difference < c, 2).otherwise(3).cast("int")


def urban_from_density(mode: Column, density: Column) -> Column:
    return F.when(mode != 0, mode).when(density > 5000, 2).when(density > 10, 1).otherwise(0).cast("int")


def label(code: Column, names: dict[int, str]) -> Column:
    """Name of a code, 'Unknown' where it has none."""
    pairs = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, code), F.lit("Unknown"))


def _clamp(x: Column, top: int) -> Column:
    return F.least(F.lit(top), F.greatest(F.lit(0), x.cast("int")))


def terrain_node(elevation: Column, zone: Column, gradient: Column) -> Column:
    bits = F.shiftleft(encode_elevation(elevation), 4).bitwiseOR(F.shiftleft(_clamp(gradient, 3), 2)).bitwiseOR(_clamp(zone, 3))
    return bits.bitwiseOR(F.lit(LEAF)).cast("int")


def population_node(density: Column, urban: Column) -> Column:
    return F.shiftleft(encode_pop_density(density), 3).bitwiseOR(_clamp(urban, 7)).bitwiseOR(F.lit(LEAF)).cast("int")


def bits(node: Column, shift: int, width: int) -> Column:
    return F.shiftright(node, shift).bitwiseAND(F.lit((1 << width) - 1)).cast("int")
