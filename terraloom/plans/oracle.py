"""Plain SQL for the same results, for a check by another engine."""

from __future__ import annotations

from .fixtures import NEEDS, VIEWS

#: Steps that several statements share, and what each reads.
STEPS = {
    "whole": (["px"], "SELECT * FROM px WHERE tile_id IN (SELECT tile_id FROM px GROUP BY tile_id HAVING count(*) = 1024)"),
    "zoned": (
        ["whole"],
        """SELECT tile_id, tile_lat, tile_lon, r, c, dem, coalesce(pop, 0) AS pop, esa,
  CASE WHEN esa = 10 THEN 2 WHEN esa IN (70, 90, 95) THEN 3 WHEN esa = 80 THEN 0 ELSE 1 END AS zone, CASE WHEN esa = 50 THEN 1 ELSE 0 END AS urban FROM whole""",
    ),
    "dried": (["zoned"], "SELECT *, CASE WHEN zone = 0 AND pop > 10 THEN 1 WHEN zone = 0 AND dem > 0 THEN 1 ELSE zone END AS zone2 FROM zoned"),
    "fixed": (
        ["dried"],
        "SELECT tile_id, tile_lat, tile_lon, r, c, dem, zone2 AS zone, CASE WHEN zone2 = 0 THEN 0 ELSE pop END AS pop, CASE WHEN zone2 = 0 OR (zone = 0 AND pop > 10) THEN 0 ELSE urban END AS urban FROM dried",
    ),
    "facts": (
        ["whole", "fixed"],
        """SELECT a.*, b.all_water FROM (SELECT tile_id, any_value(tile_lat) AS tile_lat, any_value(tile_lon) AS tile_lon, min(dem) IS NOT NULL AND NOT (min(dem) = 0 AND max(dem) = 0) AS has_dem,
  count(esa) > 0 AS has_cover, avg(CASE WHEN esa = 80 THEN 1.0 WHEN esa IS NOT NULL THEN 0.0 END) AS share FROM whole GROUP BY tile_id) a
  JOIN (SELECT tile_id, max(zone) = 0 AND max(pop) <= 10 AS all_water FROM fixed GROUP BY tile_id) b USING (tile_id)""",
    ),
    "states": (["facts"], "SELECT tile_id, tile_lat, tile_lon, CASE WHEN NOT has_dem THEN CASE WHEN has_cover AND share > 0.95 THEN 'ocean' ELSE 'no_data' END WHEN all_water THEN 'water' ELSE 'ok' END AS status FROM facts"),
    "sloped": (
        ["fixed", "facts"],
        """SELECT f.*, greatest(coalesce(abs(dem - lag(dem) OVER a), 0), coalesce(abs(dem - lead(dem) OVER a), 0), coalesce(abs(dem - lag(dem) OVER d), 0), coalesce(abs(dem - lead(dem) OVER d), 0)) AS grad
  FROM fixed f WHERE tile_id IN (SELECT tile_id FROM facts WHERE has_dem)
  WINDOW a AS (PARTITION BY tile_id, r ORDER BY c), d AS (PARTITION BY tile_id, c ORDER BY r)""",
    ),
    "pyramid": (
        ["sloped"],
        """SELECT tile_id, any_value(tile_lat) AS tile_lat, any_value(tile_lon) AS tile_lon, level, r >> (5 - level) AS qr, c >> (5 - level) AS qc, count(*) AS n, sum(dem) AS s, sum(dem * dem) AS ss, min(dem) AS low, max(dem) AS high,
  count(*) FILTER (zone = 0) AS z0, count(*) FILTER (zone = 1) AS z1, count(*) FILTER (zone = 2) AS z2, count(*) FILTER (zone = 3) AS z3, sum(pop) AS ps, sum(pop * pop) AS pss, max(pop) AS most, max(grad) AS grad,
  count(*) FILTER (urban = 0) AS u0, count(*) FILTER (urban = 1) AS u1 FROM sloped CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS l(level) GROUP BY tile_id, level, r >> (5 - level), c >> (5 - level)""",
    ),
    "judged": (
        ["pyramid"],
        """SELECT *, s / n AS mean, ps / n AS people, ss / n - (s / n) * (s / n) AS var, pss / n - (ps / n) * (ps / n) AS pvar, greatest(abs(low - s / n), abs(high - s / n)) AS err,
  (n - greatest(z0, z1, z2, z3)) / n AS minority FROM pyramid""",
    ),
    "nodes": (
        ["judged"],
        """SELECT *, CASE WHEN level = 0 THEN true WHEN level = 4 THEN false WHEN level < 3 THEN true WHEN z0 = n THEN most > 10 AND (var >= 1 OR err >= 4)
  WHEN z0 > 0 THEN minority >= 0.02 OR var >= 5 OR err >= 4 ELSE minority >= 0.02 OR var >= 1 OR err >= 4 END AS t_split,
  CASE WHEN level = 0 THEN true WHEN level = 4 OR most <= 1 THEN false WHEN level < 4 THEN true END AS p_split,
  CASE WHEN z0 = n THEN most > 10 AND (var >= 1 OR err >= 4) WHEN z0 > 0 THEN minority >= 0.02 OR var >= 5 OR err >= 4 ELSE minority >= 0.02 OR var >= 1 OR err >= 4 END AS t_rule,
  most > 1 AND (most >= greatest(3 * people, people + 25) OR pvar >= 16) AS p_rule,
  array_to_string(list_transform(range(level), lambda i: ((qc >> (level - 1 - i)) & 1) + 2 * ((qr >> (level - 1 - i)) & 1)), '') AS path FROM judged""",
    ),
    "terrain": (
        ["nodes"],
        """SELECT tile_id, tile_lat, tile_lon, path, CAST(level AS INT) AS level, CAST(qr * (32 >> level) AS INT) AS r0, CAST(qc * (32 >> level) AS INT) AS c0, CAST(32 >> level AS INT) AS size, mean AS elev,
  CASE WHEN z0 = greatest(z0, z1, z2, z3) THEN CASE WHEN mean > 0 OR most > 10 THEN 1 ELSE 0 END WHEN z1 = greatest(z0, z1, z2, z3) THEN 1 WHEN z2 = greatest(z0, z1, z2, z3) THEN 2 ELSE 3 END AS zone,
  CASE WHEN grad < 10 THEN 0 WHEN grad < 50 THEN 1 WHEN grad < 200 THEN 2 ELSE 3 END AS gradient
  FROM nodes a WHERE NOT t_split AND NOT EXISTS (SELECT 1 FROM nodes b WHERE b.tile_id = a.tile_id AND b.level < a.level AND NOT b.t_split AND starts_with(a.path, b.path))""",
    ),
    "population": (
        ["nodes"],
        """SELECT tile_id, tile_lat, tile_lon, path, CAST(level AS INT) AS level, CAST(qr * (32 >> level) AS INT) AS r0, CAST(qc * (32 >> level) AS INT) AS c0, CAST(32 >> level AS INT) AS size, people AS density,
  CASE WHEN u1 > u0 THEN 1 WHEN people > 5000 THEN 2 WHEN people > 10 THEN 1 ELSE 0 END AS urban
  FROM nodes a WHERE NOT p_split AND NOT EXISTS (SELECT 1 FROM nodes b WHERE b.tile_id = a.tile_id AND b.level < a.level AND NOT b.p_split AND starts_with(a.path, b.path))""",
    ),
    "leaf_t": (
        ["terrain"],
        """SELECT tile_lat, tile_lon, r0, c0, size, CASE WHEN m <= 511 THEN m WHEN m <= 1535 THEN 512 + (m - 512) // 2 * 2 WHEN m <= 3583 THEN 1536 + (m - 1536) // 4 * 4 ELSE 3584 + least(511, (m - 3584) // 8) * 8 END AS elevation, zone, gradient
  FROM (SELECT *, greatest(0, least(8190, CAST(trunc(elev) AS INT))) AS m FROM terrain)""",
    ),
    "leaf_p": (
        ["population"],
        """SELECT tile_lat, tile_lon, r0, c0, size, CASE WHEN density <= 0 THEN 0 ELSE CAST(greatest(1, round_even(exp(greatest(1, least(4095, CAST(floor(ln(1 + density) * 355.7) AS INT))) / 355.7) - 1, 0)) AS INT) END AS density, urban FROM population""",
    ),
    "keyed": (
        ["cities"],
        """SELECT *, CASE WHEN ok THEN CAST(floor(la) AS INT) END AS tile_lat, CASE WHEN ok THEN CAST(floor(lo) AS INT) END AS tile_lon, CASE WHEN ok THEN la - floor(la) END AS frac_lat, CASE WHEN ok THEN lo - floor(lo) END AS frac_lon
  FROM (SELECT *, la >= -90 AND la < 90 AND lo >= -180 AND lo < 180 AS ok FROM cities)""",
    ),
    "grid3": (["states"], "SELECT tile_lat, tile_lon, status <> 'ok' AS is_water, CAST(i AS INT) AS row, CAST(j AS INT) AS col, i * 0.25 AS frac_lat, j * 0.25 AS frac_lon FROM states CROSS JOIN range(1, 4) AS a(i) CROSS JOIN range(1, 4) AS b(j) WHERE status <> 'no_data'"),
    "samples": (
        ["grid3", "leaf_t", "leaf_p"],
        """SELECT g.tile_lat, g.tile_lon, row, col, is_water, CASE WHEN is_water THEN 0 ELSE elevation END AS elevation, CASE WHEN is_water THEN 0 ELSE zone END AS zone, CASE WHEN is_water THEN 0 ELSE gradient END AS gradient,
  CASE WHEN is_water THEN 0 ELSE density END AS density, CASE WHEN is_water THEN 0 ELSE urban END AS urban FROM grid3 g
  LEFT JOIN leaf_t t ON {at_t} LEFT JOIN leaf_p p ON {at_p}""",
    ),
    "heat": (
        ["footprints"],
        """SELECT item_id, row, col, CASE WHEN ok THEN CAST(floor(la) AS INT) END AS tile_lat, CASE WHEN ok THEN CAST(floor(lo) AS INT) END AS tile_lon, la - floor(la) AS frac_lat, lo - floor(lo) AS frac_lon FROM (
  SELECT *, la >= -90 AND la < 90 AND lo >= -180 AND lo < 180 AS ok FROM (SELECT item_id, CAST(i AS INT) AS row, CAST(j AS INT) AS col, lat_max - (lat_max - lat_min) * (i / 4.0::DOUBLE) AS la, lon_min + (lon_max - lon_min) * (j / 3.0::DOUBLE) AS lo FROM footprints CROSS JOIN range(5) AS a(i) CROSS JOIN range(4) AS b(j)))""",
    ),
    "over": (
        ["tile_files"],
        "SELECT tile_id, CAST(a.i AS INT) AS i, CAST(b.j AS INT) AS j, tile_lat, tile_lon, (a.i + 0.5::DOUBLE) / 2 AS frac_lat, (b.j + 0.5::DOUBLE) / 2 AS frac_lon FROM tile_files CROSS JOIN range(2) AS a(i) CROSS JOIN range(2) AS b(j)",
    ),
    "land": (["land_tiles"], "SELECT DISTINCT tile_lat, tile_lon FROM land_tiles"),
    "ocean": (["tile_files", "land"], "SELECT f.*, (SELECT count(*) FROM land) >= 12000 AND l.tile_lat IS NULL AS is_ocean FROM tile_files f LEFT JOIN land l USING (tile_lat, tile_lon)"),
    "spots": (
        ["cities"],
        """SELECT city_id, n, p, la, lo, 0 AS sample, la + 0.0 AS sample_la, lo + 0.0 AS sample_lo FROM cities UNION ALL
  SELECT city_id, n, p, la, lo, s, la + dla, lo + dlo FROM cities CROSS JOIN (VALUES (1, -0.02, -0.02), (2, -0.02, 0.0), (3, -0.02, 0.02), (4, 0.0, -0.02), (5, 0.0, 0.02), (6, 0.02, -0.02), (7, 0.02, 0.0), (8, 0.02, 0.02)) AS o(s, dla, dlo)""",
    ),
    "placed": (
        ["spots"],
        """SELECT *, CASE WHEN ok THEN CAST(floor(sample_la) AS INT) END AS tile_lat, CASE WHEN ok THEN CAST(floor(sample_lo) AS INT) END AS tile_lon, sample_la - floor(sample_la) AS frac_lat, sample_lo - floor(sample_lo) AS frac_lon
  FROM (SELECT *, sample_la >= -90 AND sample_la < 90 AND sample_lo >= -180 AND sample_lo < 180 AS ok FROM spots WHERE NOT (la = 0 AND lo = 0))""",
    ),
    "found": (
        ["placed", "states", "leaf_t", "leaf_p"],
        """SELECT g.*, s.status IS NOT NULL AS has_tile, CASE WHEN s.status <> 'ok' THEN 0 ELSE elevation END AS elevation, CASE WHEN s.status <> 'ok' THEN 0 ELSE zone END AS zone, CASE WHEN s.status <> 'ok' THEN 0 ELSE coalesce(density, 0) END AS density
  FROM placed g LEFT JOIN (SELECT * FROM states WHERE status <> 'no_data') s USING (tile_lat, tile_lon) LEFT JOIN leaf_t t ON {at_t} LEFT JOIN leaf_p p ON {at_p}""",
    ),
    "verified": (
        ["found"],
        """SELECT city_id, n, CASE WHEN NOT has_tile THEN 'missing_tile' WHEN zone IS NULL THEN 'no_data' WHEN (zone = 0 AND (centre > 50 OR p > 10000)) OR bad > 0 THEN 'bad' WHEN zone = 0 OR water > 0 THEN 'warning' ELSE 'ok' END AS status, zone, elevation, density FROM (
  SELECT city_id, n, any_value(p) AS p, bool_or(has_tile) FILTER (sample = 0) AS has_tile, max(zone) FILTER (sample = 0) AS zone, max(elevation) FILTER (sample = 0) AS elevation, max(density) FILTER (sample = 0) AS centre, count(*) FILTER (zone = 0) AS water,
  count(*) FILTER (zone = 0 AND (density > 50 OR (sample = 0 AND p > 10000))) AS bad, max(density) FILTER (zone IS NOT NULL OR sample = 0) AS density FROM found GROUP BY city_id, n)""",
    ),
    "urban_bad": (["samples"], "SELECT tile_lat, tile_lon, count(*) FILTER (density >= 5 AND urban = 0) AS hits, max(density) AS max_pop FROM samples WHERE NOT is_water AND zone IS NOT NULL AND density IS NOT NULL GROUP BY tile_lat, tile_lon HAVING count(*) FILTER (density >= 5 AND urban = 0) > 0"),
}
#: Whether a point lies in a leaf.
AT = "{x}.tile_lat = g.tile_lat AND {x}.tile_lon = g.tile_lon AND 31 - CAST(floor(g.frac_lat * 32) AS INT) >= {x}.r0 AND 31 - CAST(floor(g.frac_lat * 32) AS INT) < {x}.r0 + {x}.size AND CAST(floor(g.frac_lon * 32) AS INT) >= {x}.c0 AND CAST(floor(g.frac_lon * 32) AS INT) < {x}.c0 + {x}.size"


STEPS["problems"] = (
    ["samples", "land"],
    """SELECT tile_lat, tile_lon, hits, water, valid FROM (SELECT q.*, (SELECT count(*) FROM land) >= 12000 AND l.tile_lat IS NULL AS is_ocean FROM (
  SELECT tile_lat, tile_lon, count(*) FILTER (zone = 0 AND NOT is_water AND (density >= 10 OR urban > 0)) AS hits, count(*) FILTER (zone = 0) AS water, count(*) AS valid FROM samples WHERE zone IS NOT NULL GROUP BY tile_lat, tile_lon) q LEFT JOIN land l USING (tile_lat, tile_lon)) WHERE hits >= 1 OR (water >= valid AND NOT is_ocean)""",
)
STEPS["statuses"] = (
    ["facts", "land"],
    """SELECT tile_id, tile_lat, tile_lon, CASE WHEN ocean AND NOT has_cover THEN 'no_data' WHEN ocean AND share > 0.95 THEN 'ocean' WHEN ocean AND abs(tile_lat) >= 80 THEN 'no_data' WHEN NOT has_dem THEN CASE WHEN has_cover AND share > 0.95 THEN 'ocean' ELSE 'no_data' END WHEN all_water THEN 'water' ELSE 'ok' END AS status
  FROM (SELECT f.*, (SELECT count(*) FROM land) >= 12000 AND l.tile_lat IS NULL AS ocean FROM facts f LEFT JOIN land l USING (tile_lat, tile_lon))""",
)


STEPS["city_bad"] = (
    ["keyed", "states", "leaf_t", "leaf_p"],
    f"""SELECT city_id, n, p, zone, density, urban, concat_ws('; ', CASE WHEN zone = 0 AND density >= 5 THEN concat('zone=water but pop=', density) END, CASE WHEN density >= 5 AND urban = 0 THEN concat('pop=', density, ' but urban=0') END) AS issues
  FROM (SELECT g.*, zone, density, urban FROM keyed g JOIN states s ON s.tile_lat = g.tile_lat AND s.tile_lon = g.tile_lon AND s.status = 'ok' JOIN leaf_t t ON {AT.format(x="t")} JOIN leaf_p p ON {AT.format(x="p")} WHERE NOT (la = 0 AND lo = 0) AND density >= 5 AND (zone = 0 OR urban = 0))""",
)
#: Both layers at points with tile_lat, tile_lon, frac_lat and frac_lon.
SAMPLED = f"""SELECT {{key}}, CASE WHEN status <> 'ok' THEN 0 ELSE elevation END AS elevation, CASE WHEN status <> 'ok' THEN 0 ELSE zone END AS zone, CASE WHEN status <> 'ok' THEN 0 ELSE gradient END AS gradient,
  CASE WHEN status <> 'ok' THEN 0 ELSE density END AS density, CASE WHEN status <> 'ok' THEN 0 ELSE urban END AS urban
  FROM {{points}} g {{join}} (SELECT * FROM states WHERE status <> 'no_data') s ON s.tile_lat = g.tile_lat AND s.tile_lon = g.tile_lon
  LEFT JOIN leaf_t t ON s.status = 'ok' AND {AT.format(x="t")} LEFT JOIN leaf_p p ON s.status = 'ok' AND {AT.format(x="p")} WHERE {{kept}}"""


#: Steps that are made once, however many read them.
KEPT = {"nodes", "t_tree", "p_tree", "t_sized", "p_sized", "t_shares", "p_shares", "laid", "deep_nodes", "deep_sloped"}


def statement(names: list[str], body: str) -> str:
    """The body after a WITH of all steps and views that it needs, each once and in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for need in STEPS[name][0] if name in STEPS else [n for n in NEEDS[name] if n in VIEWS]:
            visit(need)
        order.append(name)

    for n in names:
        visit(n)
    texts = {n: STEPS[n][1].replace("{at_t}", AT.format(x="t")).replace("{at_p}", AT.format(x="p")) if n in STEPS else VIEWS[n] for n in order}
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in KEPT else ''}({t})" for n, t in texts.items()) + "\n" + body if order else body


def encoded(m: str) -> str:
    return f"CASE WHEN {m} <= 511 THEN {m} WHEN {m} <= 1535 THEN 512 + ({m} - 512) // 2 WHEN {m} <= 3583 THEN 1024 + ({m} - 1536) // 4 ELSE 1536 + least(511, ({m} - 3584) // 8) END"


def decoded(s: str) -> str:
    return f"CASE WHEN {s} <= 511 THEN {s} WHEN {s} <= 1023 THEN 512 + ({s} - 512) * 2 WHEN {s} <= 1535 THEN 1536 + ({s} - 1024) * 4 ELSE 3584 + ({s} - 1536) * 8 END"


CLAMPED = "greatest(0, least(8190, CAST(trunc(dem * 1.3) AS INT)))"
POP_CODE = "CASE WHEN pop <= 0 THEN 0 ELSE greatest(1, least(4095, CAST(floor(ln(1 + pop) * 355.7) AS INT))) END"
ZONE = "CASE WHEN esa = 10 THEN 2 WHEN esa IN (70, 90, 95) THEN 3 WHEN esa = 80 THEN 0 ELSE 1 END"
ZONE_OF_BLOCK = "CASE WHEN z0 = greatest(z0, z1, z2, z3) THEN CASE WHEN mean > 0 OR most > 10 THEN 1 ELSE 0 END WHEN z1 = greatest(z0, z1, z2, z3) THEN 1 WHEN z2 = greatest(z0, z1, z2, z3) THEN 2 ELSE 3 END"
NAME = "concat(tile_lon, '_', tile_lat, '.qtree')"


def _tree(kind: str, code: str) -> None:
    """Steps for the nodes of one tree, its payload as digits, and what a budget leaves each block."""
    STEPS[f"{kind}_tree"] = (
        ["nodes"],
        f"SELECT a.tile_id, a.level, a.path, a.{kind}_split AS splits, CASE WHEN a.level = 4 THEN a.{kind}_rule ELSE a.{kind}_split END AS wants, CAST({code} AS BIGINT) AS code FROM nodes a WHERE NOT EXISTS (SELECT 1 FROM nodes b WHERE b.tile_id = a.tile_id AND b.level < a.level AND NOT b.{kind}_split AND starts_with(a.path, b.path))",
    )
    STEPS[f"{kind}_sized"] = (
        [f"{kind}_tree"],
        f"SELECT a.tile_id, a.level, a.path, any_value(a.wants) AS wants, CASE WHEN any_value(a.splits) THEN count(*) ELSE any_value(a.code) END AS node, count(*) AS n FROM {kind}_tree a JOIN {kind}_tree b ON b.tile_id = a.tile_id AND starts_with(b.path, a.path) GROUP BY a.tile_id, a.level, a.path",
    )
    STEPS[f"{kind}_payload"] = ([f"{kind}_sized"], f"SELECT tile_id, CAST(count(*) AS INT) AS n, string_agg(printf('%02X%02X', node & 255, node >> 8), '' ORDER BY path) AS digits FROM {kind}_sized GROUP BY tile_id")
    STEPS[f"{kind}_shares"] = (
        [f"{kind}_sized"],
        f"""SELECT tile_id, level, path, left(path, level - 1) AS above, wants, CAST(right(path, 1) AS INT) AS k, coalesce(sum(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used, sum(CASE WHEN wants THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still
  FROM {kind}_sized WHERE level > 0 WINDOW w AS (PARTITION BY tile_id, level, left(path, level - 1) ORDER BY path)""",
    )
    # a child's part depends on what its parent has and on the sizes of the children before it
    STEPS[f"{kind}_cuts"] = (
        [f"{kind}_shares", "budgets"],
        f"""SELECT DISTINCT tile_id FROM (WITH RECURSIVE had AS (SELECT tile_id, CAST(0 AS BIGINT) AS level, '' AS path, CAST({kind}_budget AS BIGINT) AS have, true AS wants FROM budgets UNION ALL
  SELECT s.tile_id, CAST(s.level AS BIGINT), s.path, CAST(CASE WHEN s.wants THEN least(1 + greatest(0, h.have - 1 - s.used - (4 - s.k)) // greatest(1, s.still), h.have - 1 - s.used - (3 - s.k)) ELSE 1 END AS BIGINT), s.wants FROM had h JOIN {kind}_shares s ON s.tile_id = h.tile_id AND s.above = h.path AND s.level = h.level + 1 WHERE h.have >= 5)
  SELECT * FROM had) WHERE level < 4 AND wants AND have < 5""",
    )


_tree("t", "32768 + 16 * (" + encoded("greatest(0, least(8190, CAST(trunc(mean) AS INT)))") + ") + 4 * (CASE WHEN grad < 10 THEN 0 WHEN grad < 50 THEN 1 WHEN grad < 200 THEN 2 ELSE 3 END) + (" + ZONE_OF_BLOCK + ")")
_tree("p", "32768 + 8 * (" + POP_CODE.replace("pop", "people") + ") + (CASE WHEN u1 > u0 THEN 1 WHEN people > 5000 THEN 2 WHEN people > 10 THEN 1 ELSE 0 END)")
STEPS["payloads"] = (["t_payload", "p_payload"], "SELECT t.tile_id, t.n AS t_nodes, p.n AS p_nodes, t.digits AS t_hex, p.digits AS p_hex FROM t_payload t JOIN p_payload p USING (tile_id)")
STEPS["files_of"] = (
    ["states", "payloads"],
    "SELECT tile_id, tile_lat, tile_lon, CAST(CASE WHEN status = 'ok' THEN 2 * t_nodes ELSE 1 END AS BIGINT) AS bytes, md5(CASE WHEN status = 'ok' THEN t_hex ELSE 'FF' END) AS digest FROM states LEFT JOIN payloads USING (tile_id) WHERE status <> 'no_data'",
)
STEPS["budgets"] = (["states", "payloads"], "SELECT tile_id, t_nodes, p_nodes, 240 AS t_budget, 200 AS p_budget FROM states JOIN payloads USING (tile_id) WHERE status = 'ok'")


STEPS["laid"] = (
    ["states", "payloads"],
    f"""SELECT *, coalesce(sum(n) OVER (PARTITION BY path ORDER BY name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin, row_number() OVER (PARTITION BY path ORDER BY name) AS seq FROM (
  SELECT *, format('terrain_{{}}{{:03d}}_{{}}{{:02d}}.gsh', CASE WHEN lon0 < 0 THEN '-' ELSE '+' END, abs(lon0), CASE WHEN lat0 < 0 THEN '-' ELSE '+' END, abs(lat0)) AS path, (tile_lat - lat0) * 10 + tile_lon - lon0 AS place FROM (
  SELECT tile_id, {NAME} AS name, tile_lat, tile_lon, CAST(floor((tile_lat + 90) / 10) * 10 - 90 AS INT) AS lat0, CAST(floor((tile_lon + 180) / 10) * 10 - 180 AS INT) AS lon0, CAST(CASE WHEN status = 'ok' THEN 2 * t_nodes ELSE 1 END AS BIGINT) AS n, CASE WHEN status = 'ok' THEN t_hex ELSE 'FF' END AS digits FROM states LEFT JOIN payloads USING (tile_id) WHERE status <> 'no_data'))""",
)


def _le(value: str, size: int) -> str:
    """A number as digits of ``size`` bytes, the lowest first."""
    return "concat(" + ", ".join(f"printf('%02X', (CAST({value} AS BIGINT) >> {8 * i}) & 255)" for i in range(size)) + ")"


STEPS["deep_sloped"] = (
    ["px_deep"],
    """SELECT *, greatest(coalesce(abs(dem - lag(dem) OVER a), 0), coalesce(abs(dem - lead(dem) OVER a), 0), coalesce(abs(dem - lag(dem) OVER d), 0), coalesce(abs(dem - lead(dem) OVER d), 0)) AS grad
  FROM px_deep WHERE tile_id IN (SELECT tile_id FROM px_deep GROUP BY tile_id HAVING count(*) = 4096) WINDOW a AS (PARTITION BY tile_id, r ORDER BY c), d AS (PARTITION BY tile_id, c ORDER BY r)""",
)
STEPS["deep_nodes"] = (
    ["deep_sloped"],
    """SELECT *, CASE WHEN level = 0 THEN true WHEN level = 5 THEN false WHEN level < 3 THEN true WHEN z0 = n THEN most > 10 AND (var >= 1 OR err >= 4) WHEN z0 > 0 THEN minority >= 0.02 OR var >= 5 OR err >= 4 ELSE minority >= 0.02 OR var >= 1 OR err >= 4 END AS t_split,
  CASE WHEN level = 0 THEN true WHEN level = 5 OR most <= 1 THEN false WHEN level < 4 THEN true ELSE kinds > 1 OR most >= greatest(3 * people, people + 25) OR pvar >= 16 END AS p_split,
  array_to_string(list_transform(range(level), lambda i: ((qc >> (level - 1 - i)) & 1) + 2 * ((qr >> (level - 1 - i)) & 1)), '') AS path FROM (
  SELECT *, s / n AS mean, ps / n AS people, ss / n - (s / n) * (s / n) AS var, pss / n - (ps / n) * (ps / n) AS pvar, greatest(abs(low - s / n), abs(high - s / n)) AS err, (n - greatest(z0, z1, z2, z3)) / n AS minority FROM (
  SELECT tile_id, level, r >> (6 - level) AS qr, c >> (6 - level) AS qc, count(*) AS n, sum(dem) AS s, sum(dem * dem) AS ss, min(dem) AS low, max(dem) AS high, count(*) FILTER (zone = 0) AS z0, count(*) FILTER (zone = 1) AS z1, count(*) FILTER (zone = 2) AS z2, count(*) FILTER (zone = 3) AS z3,
  sum(pop) AS ps, sum(pop * pop) AS pss, max(pop) AS most, max(grad) AS grad, count(DISTINCT urban) FILTER (urban > 0) AS kinds, list(urban) AS towns FROM deep_sloped CROSS JOIN range(6) AS l(level) GROUP BY tile_id, level, r >> (6 - level), c >> (6 - level)))""",
)
for _kind in "tp":
    STEPS[f"deep_{_kind}"] = (["deep_nodes"], f"SELECT a.* FROM deep_nodes a WHERE NOT EXISTS (SELECT 1 FROM deep_nodes b WHERE b.tile_id = a.tile_id AND b.level < a.level AND NOT b.{_kind}_split AND starts_with(a.path, b.path))")


def _shards(prefix: str, size: str) -> str:
    return f"""SELECT format('{prefix}_{{}}{{:03d}}_{{}}{{:02d}}.gsh', CASE WHEN shard_lon < 0 THEN '-' ELSE '+' END, abs(shard_lon), CASE WHEN shard_lat < 0 THEN '-' ELSE '+' END, abs(shard_lat)) AS path, '{prefix}' AS kind, shard_lat, shard_lon, 10 AS tile_w, 10 AS tile_h,
  count(*) AS tile_count, CAST(800 AS BIGINT) AS index_bytes, CAST(sum({size}) AS BIGINT) AS data_bytes, CAST(sum({size}) AS BIGINT) AS raw_bytes, CAST(836 + sum({size}) AS BIGINT) AS file_bytes
  FROM (SELECT *, CAST(floor((tile_lat + 90) / 10) * 10 - 90 AS INT) AS shard_lat, CAST(floor((tile_lon + 180) / 10) * 10 - 180 AS INT) AS shard_lon FROM tile_files WHERE {size} IS NOT NULL) GROUP BY shard_lat, shard_lon"""


def oracle_sql() -> dict[str, str]:
    s = statement
    out = {
        "read_raster_layers": s(["whole"], "SELECT tile_id, r, c, greatest(coalesce(pop, 0), 0) AS pop FROM whole"),
        "read_tile_list": s(
            ["tile_list_lines"],
            """SELECT line_no, CAST(parts[2] AS INT) AS tile_lat, CAST(parts[1] AS INT) AS tile_lon FROM (SELECT *, list_filter(string_split(replace(replace(trim(line), chr(9), ','), ' ', ','), ','), lambda x: x <> '') AS parts FROM tile_list_lines WHERE trim(line) <> '' AND NOT starts_with(trim(line), '#'))
  WHERE len(parts) >= 2 AND try_cast(parts[1] AS INT) IS NOT NULL AND try_cast(parts[2] AS INT) IS NOT NULL""",
        ),
        "read_cities": s(["cities"], "SELECT n, la, lo, p FROM cities WHERE NOT (la = 0 AND lo = 0)"),
        "read_land_index": s(["land"], "SELECT tile_lat, tile_lon FROM land"),
        "write_land_index": s(["land"], "SELECT tile_lat, tile_lon FROM land WHERE (SELECT count(*) FROM land) >= 12000"),
        "geojson_extent": s(["footprints"], "SELECT round(min(lon_min) - greatest(1e-6, max(lon_max) - min(lon_min)) * 0.02, 6) AS west, round(max(lon_max) + greatest(1e-6, max(lon_max) - min(lon_min)) * 0.02, 6) AS east, round(min(lat_min) - greatest(1e-6, max(lat_max) - min(lat_min)) * 0.02, 6) AS south, round(max(lat_max) + greatest(1e-6, max(lat_max) - min(lat_min)) * 0.02, 6) AS north FROM footprints"),
        "write_tile_list": s(["tile_files"], "SELECT concat(tile_lon, ',', tile_lat) AS line FROM tile_files WHERE terrain_bytes <= 1"),
        "write_bake_log": s(["bake_log"], "SELECT idx, tile_lat, tile_lon, status, CAST(nodes AS BIGINT) AS nodes, download_ms, quadtree_ms FROM bake_log"),
        "tile_key": s(["keyed"], "SELECT city_id, tile_lat, tile_lon, frac_lat, frac_lon FROM keyed"),
        "tile_index": s(["tile_files"], "SELECT tile_id, CAST((tile_lat + 90) * 360 + tile_lon + 180 AS INT) AS tile_idx, tile_lat AS back_lat, tile_lon AS back_lon FROM tile_files"),
        "shard_key": s(
            ["tile_files"],
            """SELECT tile_id, shard_lat, shard_lon, least(7, 180 - shard_lon) AS tile_w, least(7, 90 - shard_lat) AS tile_h, CAST((tile_lat - shard_lat) * least(7, 180 - shard_lon) + tile_lon - shard_lon AS INT) AS local_idx
  FROM (SELECT *, CAST((tile_lat + 90) // 7 * 7 - 90 AS INT) AS shard_lat, CAST((tile_lon + 180) // 7 * 7 - 180 AS INT) AS shard_lon FROM tile_files)""",
        ),
        "bbox_tiles": s(["footprints"], "SELECT item_id, CAST(i AS INT) AS tile_lat, CAST(j AS INT) AS tile_lon FROM footprints JOIN range(-90, 90) AS a(i) ON i >= floor(lat_min) AND i < ceil(lat_max) JOIN range(-180, 180) AS b(j) ON j >= floor(lon_min) AND j < ceil(lon_max)"),
        "global_tiles": s(["tile_files"], "SELECT CAST(i AS INT) AS tile_idx, CAST(i // 360 - 90 AS INT) AS tile_lat, CAST(i % 360 - 180 AS INT) AS tile_lon, EXISTS (SELECT 1 FROM tile_files f WHERE (f.tile_lat + 90) * 360 + f.tile_lon + 180 = i) AS baked FROM range(64800) AS t(i)"),
        "split_tiles": s(["tile_files"], "SELECT tile_id, tile_lat, tile_lon FROM (SELECT *, row_number() OVER (ORDER BY tile_lat, tile_lon) - 1 AS k FROM tile_files) WHERE k % 7 = 2"),
        "cells_of_footprint": s(["footprints"], "SELECT DISTINCT CAST(i AS INT) AS tile_lat, CAST(j AS INT) AS tile_lon FROM footprints JOIN range(-90, 90) AS a(i) ON i BETWEEN floor(lat_min) AND ceil(lat_max) JOIN range(-180, 180) AS b(j) ON j BETWEEN floor(lon_min) AND ceil(lon_max)"),
        "tile_sample_points": s(["tile_files"], "SELECT tile_id, CAST(i AS INT) AS row, CAST(j AS INT) AS col, CAST(i * 0.25 AS DOUBLE) AS frac_lat, CAST(j * 0.25 AS DOUBLE) AS frac_lon FROM tile_files CROSS JOIN range(1, 4) AS a(i) CROSS JOIN range(1, 4) AS b(j)"),
        "bbox_sample_grid": s(["footprints"], "SELECT item_id, CAST(i AS INT) AS row, CAST(j AS INT) AS col, lat_max - (lat_max - lat_min) * (i / 4.0::DOUBLE) AS la, lon_min + (lon_max - lon_min) * (j / 3.0::DOUBLE) AS lo FROM footprints CROSS JOIN range(5) AS a(i) CROSS JOIN range(4) AS b(j)"),
        "overview_sample_grid": s(["tile_files"], "SELECT tile_id, CAST(i AS INT) AS i, CAST(j AS INT) AS j, tile_lat + (i + 0.5::DOUBLE) / 2 AS la, tile_lon + (j + 0.5::DOUBLE) / 2 AS lo FROM tile_files CROSS JOIN range(2) AS a(i) CROSS JOIN range(2) AS b(j)"),
        "city_sample_offsets": s(["spots"], "SELECT city_id, sample, CAST(sample_la AS DOUBLE) AS sample_la, CAST(sample_lo AS DOUBLE) AS sample_lo FROM spots"),
        "encode_elevation": s(["px"], f"SELECT tile_id, r, c, CASE WHEN dem IS NOT NULL THEN {encoded(CLAMPED)} END AS code FROM px"),
        "decode_elevation": s(["px"], f"SELECT tile_id, r, c, CASE WHEN dem IS NOT NULL THEN {decoded('code')} END AS metres FROM (SELECT *, {encoded(CLAMPED)} AS code FROM px)"),
        "encode_pop_density": s(["px"], f"SELECT tile_id, r, c, CASE WHEN pop IS NOT NULL THEN {POP_CODE} END AS code FROM px"),
        "decode_pop_density": s(["px"], f"SELECT tile_id, r, c, CAST(CASE WHEN code IS NULL THEN NULL WHEN code <= 0 THEN 0 ELSE greatest(1, round_even(exp(code / 355.7) - 1, 0)) END AS INT) AS density FROM (SELECT *, CASE WHEN pop IS NOT NULL THEN {POP_CODE} END AS code FROM px)"),
        "landcover_zone": s(["px"], f"SELECT tile_id, r, c, {ZONE} AS zone, CASE WHEN esa = 50 THEN 1 ELSE 0 END AS urban FROM px"),
        "gradient_level": s(["px"], "SELECT tile_id, r, c, CASE WHEN g < 10 THEN 0 WHEN g < 50 THEN 1 WHEN g < 200 THEN 2 ELSE 3 END AS level FROM (SELECT *, coalesce(dem, 0) % 300 AS g FROM px)"),
        "urban_from_density": s(["px"], "SELECT tile_id, r, c, CASE WHEN esa = 50 THEN 1 WHEN pop > 5000 THEN 2 WHEN pop > 10 THEN 1 ELSE 0 END AS urban FROM px"),
        "label_codes": s(["px"], f"SELECT tile_id, r, c, CASE {ZONE} WHEN 0 THEN 'Water' WHEN 1 THEN 'Natural' WHEN 2 THEN 'Forest' ELSE 'Harsh' END AS zone_name, coalesce((['Flat', 'Gentle', 'Steep', 'Cliff'])[r % 5 + 1], 'Unknown') AS gradient_name, coalesce((['Uninhabited', 'Residential', 'Commercial', 'Industrial', 'Mixed', 'Institutional', 'Reserved', 'Reserved'])[c % 10 + 1], 'Unknown') AS urban_name FROM px"),
        "node_bits": s(
            ["px"],
            f"""SELECT tile_id, r, c, 32768 + e * 16 + g * 4 + z AS terrain, 32768 + d * 8 + u AS people, e AS elev, g AS grad, z AS zone, d AS density, u AS urban
  FROM (SELECT tile_id, r, c, {encoded("CAST(dem AS INT)")} AS e, CAST(least(3, c % 5) AS INT) AS g, CAST(least(3, r % 6) AS INT) AS z, {POP_CODE} AS d, CAST(least(7, c % 9) AS INT) AS u FROM (SELECT tile_id, r, c, coalesce(dem, 0) AS dem, coalesce(pop, 0) AS pop FROM px))""",
        ),
        "quad_path": s(["keyed"], "SELECT city_id, array_to_string(list_transform(range(9), lambda i: ((x >> (8 - i)) & 1) + 2 * ((y >> (8 - i)) & 1)), '') AS path FROM (SELECT city_id, CAST(floor(frac_lon * 512) AS INT) AS x, 511 - CAST(floor(frac_lat * 512) AS INT) AS y FROM keyed WHERE ok)"),
        "likely_ocean": s(["ocean"], "SELECT tile_id, is_ocean FROM ocean"),
        "empty_raster": s(["dem_candidates"], "SELECT tile_id, prio, n_px IS NULL OR n_px = 0 OR (v_min = 0 AND v_max = 0) AS is_empty FROM dem_candidates"),
        "filter_cities": s(["cities"], "SELECT city_id, la, lo, p FROM cities WHERE lo BETWEEN -100 AND 120 AND la BETWEEN -60 AND 60 AND p >= 20000"),
        "retry_candidates": s(["ocean"], "SELECT tile_id FROM ocean WHERE terrain_bytes <= 1 AND NOT is_ocean"),
        "fuse_layers": s(["zoned"], "SELECT tile_id, r, c, dem, pop, zone, urban FROM zoned WHERE dem IS NOT NULL"),
        "pair_tiles": s(["tile_files"], "SELECT tile_lat, tile_lon, terrain_bytes, pop_bytes FROM tile_files WHERE pop_bytes IS NOT NULL"),
        "point_query_terrain": s(
            ["keyed", "states", "leaf_t"],
            f"""SELECT city_id, elevation, zone, gradient, CASE zone WHEN 0 THEN 'Water' WHEN 1 THEN 'Natural' WHEN 2 THEN 'Forest' WHEN 3 THEN 'Harsh' END AS zone_name FROM (
  SELECT city_id, CASE WHEN s.status <> 'ok' THEN 0 ELSE elevation END AS elevation, CASE WHEN s.status <> 'ok' THEN 0 ELSE zone END AS zone, CASE WHEN s.status <> 'ok' THEN 0 ELSE gradient END AS gradient
  FROM keyed g LEFT JOIN (SELECT * FROM states WHERE status <> 'no_data') s ON s.tile_lat = g.tile_lat AND s.tile_lon = g.tile_lon LEFT JOIN leaf_t t ON s.status = 'ok' AND {AT.format(x="t")})""",
        ),
        "point_query_population": s(
            ["keyed", "states", "leaf_p"],
            f"""SELECT city_id, CASE WHEN s.status <> 'ok' THEN 0 ELSE density END AS density, CASE WHEN s.status <> 'ok' THEN 0 ELSE urban END AS urban
  FROM keyed g LEFT JOIN (SELECT * FROM states WHERE status <> 'no_data') s ON s.tile_lat = g.tile_lat AND s.tile_lon = g.tile_lon LEFT JOIN leaf_p p ON s.status = 'ok' AND {AT.format(x="p")}""",
        ),
        "sample_grid_query": s(["samples"], "SELECT tile_lat, tile_lon, row, col, elevation, zone, gradient, density, urban FROM samples"),
        "heat_map_query": s(["heat", "states", "leaf_t", "leaf_p"], SAMPLED.format(key="g.item_id, g.row, g.col", points="heat", join="LEFT JOIN", kept="true")),
        "panel_query": s(["heat", "states", "leaf_t", "leaf_p"], SAMPLED.format(key="g.item_id, g.row, g.col", points="heat", join="JOIN", kept="status <> 'ok' OR (elevation IS NOT NULL AND density IS NOT NULL)")),
        "overview_query": s(["over", "states", "leaf_t", "leaf_p"], SAMPLED.format(key="g.tile_id, g.i, g.j", points="over", join="LEFT JOIN", kept="true")),
        "skip_existing": s(
            ["ocean", "land"],
            "SELECT tile_lat, tile_lon FROM (SELECT tile_lat, tile_lon FROM land UNION SELECT tile_lat, tile_lon FROM tile_files) w WHERE NOT EXISTS (SELECT 1 FROM ocean o WHERE o.tile_lat = w.tile_lat AND o.tile_lon = w.tile_lon AND terrain_bytes IS NOT NULL AND pop_bytes IS NOT NULL AND (terrain_bytes > 1 OR is_ocean))",
        ),
        "best_footprint": s(
            ["tile_files", "footprints"],
            """SELECT tile_lat, tile_lon, item_id, area FROM (SELECT *, row_number() OVER (PARTITION BY tile_lat, tile_lon ORDER BY area DESC, item_id) AS k FROM (
  SELECT tile_lat, tile_lon, item_id, (least(lat_max, tile_lat + 1) - greatest(lat_min, tile_lat)) * (least(lon_max, tile_lon + 1) - greatest(lon_min, tile_lon)) AS area FROM tile_files JOIN footprints ON least(lat_max, tile_lat + 1) > greatest(lat_min, tile_lat) AND least(lon_max, tile_lon + 1) > greatest(lon_min, tile_lon))) WHERE k = 1""",
        ),
        "source_fallback": s(["dem_candidates"], "SELECT tile_id, min(prio) AS prio FROM dem_candidates WHERE NOT (n_px IS NULL OR n_px = 0 OR (v_min = 0 AND v_max = 0)) GROUP BY tile_id"),
        "leaf_bbox_overlap": s(
            ["population", "states"],
            """SELECT tile_lat, tile_lon, path, e.edge, CASE e.edge WHEN 0 THEN w WHEN 1 THEN x WHEN 2 THEN x ELSE w END AS lo0, CASE e.edge WHEN 0 THEN y0 WHEN 1 THEN y0 WHEN 2 THEN y1 ELSE y1 END AS la0, CASE e.edge WHEN 0 THEN x WHEN 1 THEN x ELSE w END AS lo1, CASE e.edge WHEN 0 THEN y0 WHEN 1 THEN y1 WHEN 2 THEN y1 ELSE y0 END AS la1 FROM (
  SELECT p.tile_lat, p.tile_lon, path, p.tile_lat + 1 - (r0 + size) / 32 AS y0, p.tile_lat + 1 - r0 / 32 AS y1, p.tile_lon + c0 / 32 AS w, p.tile_lon + (c0 + size) / 32 AS x FROM population p JOIN states USING (tile_id) WHERE status = 'ok')
  CROSS JOIN (VALUES (0), (1), (2), (3)) AS e(edge) WHERE tile_lat BETWEEN floor(-40.3) AND floor(40.7) AND tile_lon BETWEEN floor(-100.2) AND floor(100.1) AND NOT (y1 < -40.3 OR y0 > 40.7 OR x < -100.2 OR w > 100.1) ORDER BY tile_lat, tile_lon, path, edge LIMIT 25000""",
        ),
        "resample_layer": s(
            ["whole"],
            "SELECT w.tile_id, CAST(i AS INT) AS r, CAST(j AS INT) AS c, CAST(w.esa AS INT) AS esa FROM range(12) AS a(i) CROSS JOIN range(12) AS b(j) JOIN whole w ON w.r = CAST(floor(i * (31.0::DOUBLE / 11) + 0.5) AS INT) AND w.c = CAST(floor(j * (31.0::DOUBLE / 11) + 0.5) AS INT) WHERE w.esa IS NOT NULL",
        ),
        "fix_water": s(["fixed"], "SELECT tile_id, r, c, zone, pop, urban FROM fixed"),
        "pixel_gradient": s(
            ["whole"],
            """SELECT tile_id, r, c, greatest(coalesce(abs(dem - lag(dem) OVER a), 0), coalesce(abs(dem - lead(dem) OVER a), 0), coalesce(abs(dem - lag(dem) OVER d), 0), coalesce(abs(dem - lead(dem) OVER d), 0)) AS grad FROM whole WHERE dem IS NOT NULL
  WINDOW a AS (PARTITION BY tile_id, r ORDER BY c), d AS (PARTITION BY tile_id, c ORDER BY r)""",
        ),
        "correction_counts": s(["dried"], "SELECT tile_id, count(*) FILTER (zone = 0 AND pop > 10) AS pass1, count(*) FILTER (zone = 0 AND pop <= 10 AND dem > 0) AS pass2 FROM dried GROUP BY tile_id"),
        "zone_histogram": s(["fixed"], "SELECT tile_id, count(*) FILTER (zone = 0) AS zone_0, count(*) FILTER (zone = 1) AS zone_1, count(*) FILTER (zone = 2) AS zone_2, count(*) FILTER (zone = 3) AS zone_3 FROM fixed GROUP BY tile_id"),
        "water_share": s(["whole"], "SELECT tile_id, avg(CASE WHEN esa = 80 THEN 1.0 ELSE 0.0 END) AS water_share, avg(CASE WHEN esa = 80 THEN 1.0 ELSE 0.0 END) > 0.95 AS is_ocean FROM whole WHERE esa IS NOT NULL GROUP BY tile_id"),
        "zone_mode": s(["fixed"], "SELECT tile_id, zone FROM (SELECT tile_id, zone, row_number() OVER (PARTITION BY tile_id ORDER BY count(*) DESC, zone) AS k FROM fixed GROUP BY tile_id, zone) WHERE k = 1"),
        "node_budget": s(["fixed"], "SELECT tile_id, CASE WHEN count(DISTINCT zone) > 1 OR max(pop) > 50 THEN 24000 ELSE 12000 END AS terrain_budget, CASE WHEN max(pop) > 1000 THEN 20000 WHEN max(pop) > 10 THEN 12000 ELSE 4000 END AS population_budget FROM fixed GROUP BY tile_id"),
        "quad_pyramid": s(["pyramid"], "SELECT tile_id, CAST(level AS INT) AS level, CAST(qr AS INT) AS qr, CAST(qc AS INT) AS qc, n, round(s / n, 6) AS mean, round(ss / n - (s / n) * (s / n), 4) AS variance, low, high, z0, z1, z2, z3, most AS max_pop, grad AS max_grad, CASE WHEN u1 > 0 THEN 1 ELSE 0 END AS urban_kinds FROM pyramid"),
        "terrain_leaves": s(["terrain"], "SELECT tile_id, path, level, r0, c0, size, round(elev, 6) AS elev, zone, gradient FROM terrain"),
        "population_leaves": s(["population"], "SELECT tile_id, path, level, r0, c0, size, round(density, 6) AS density, urban FROM population"),
        "bake_status": s(["statuses"], "SELECT * FROM statuses"),
        "bake_summary": s(
            ["bake_log"],
            """SELECT count(*) AS tiles, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'water') AS n_water, count(*) FILTER (status = 'ocean') AS n_ocean, count(*) FILTER (status = 'no_data') AS n_no_data, count(*) FILTER (status = 'error') AS n_error,
  round(coalesce(CAST(sum(nodes) FILTER (status = 'ok') AS DOUBLE), 0) / greatest(count(*) FILTER (status = 'ok'), 1), 6) AS mean_nodes, round(CAST(sum(download_ms) AS DOUBLE) / greatest(count(*), 1), 6) AS mean_download_ms, round(coalesce(CAST(sum(quadtree_ms) FILTER (status = 'ok') AS DOUBLE), 0) / greatest(count(*) FILTER (status = 'ok'), 1), 6) AS mean_quadtree_ms,
  round(CAST(count(*) * 1000 AS DOUBLE) / greatest(sum(download_ms + quadtree_ms), 1), 6) AS tiles_per_s FROM bake_log""",
        ),
        "near_budget": s(["bake_log"], "SELECT idx, nodes FROM bake_log WHERE nodes >= 19936"),
        "tile_stats": s(
            ["tile_files"],
            """SELECT count(*) AS tiles, count(*) FILTER (terrain_bytes <= 1) AS water_tiles, count(*) FILTER (terrain_bytes > 1) AS data_tiles, CAST(sum(terrain_bytes) AS BIGINT) AS total_bytes, CAST(sum(terrain_bytes) FILTER (terrain_bytes > 1) AS BIGINT) AS data_bytes, round(avg(terrain_bytes), 6) AS avg_bytes, round(avg(terrain_bytes) FILTER (terrain_bytes > 1), 6) AS avg_data_bytes,
  count(pop_bytes) AS pop_tiles, CAST(sum(pop_bytes) AS BIGINT) AS pop_bytes, CAST(sum(terrain_bytes) + coalesce(sum(pop_bytes), 0) AS BIGINT) AS combined_bytes FROM tile_files""",
        ),
        "size_histogram": s(
            ["tile_files"],
            "SELECT CAST(place AS INT) AS place, bucket, count(tile_id) AS tiles FROM (VALUES (0, '<1KB', 0, 1), (1, '1-10KB', 1, 10), (2, '10-50KB', 10, 50), (3, '50-100KB', 50, 100), (4, '100-500KB', 100, 500), (5, '>500KB', 500, 1000000)) AS b(place, bucket, low, high) LEFT JOIN tile_files ON terrain_bytes > 1 AND terrain_bytes / 1024 >= low AND terrain_bytes / 1024 < high GROUP BY place, bucket",
        ),
        "read_geojson_rings": s(["footprints"], "SELECT 5 AS points, lon_min AS west, lon_max AS east, lat_min AS south, lat_max AS north FROM footprints"),
        "geojson_extent": s(["footprints"], """SELECT round(w - greatest(1e-6::DOUBLE, e - w) * 0.02::DOUBLE, 6) AS west, round(e + greatest(1e-6::DOUBLE, e - w) * 0.02::DOUBLE, 6) AS east, round(s - greatest(1e-6::DOUBLE, n - s) * 0.02::DOUBLE, 6) AS south, round(n + greatest(1e-6::DOUBLE, n - s) * 0.02::DOUBLE, 6) AS north
  FROM (SELECT min(lon_min) AS w, max(lon_max) AS e, min(lat_min) AS s, max(lat_max) AS n FROM footprints)"""),
        "decode_tiles": s(
            ["terrain", "states"],
            f"""SELECT t.tile_lat, t.tile_lon, path, CAST({encoded("m")} AS INT) AS value, zone AS kind, gradient
  FROM (SELECT *, greatest(0, least(8190, CAST(trunc(elev) AS INT))) AS m FROM terrain) t JOIN states USING (tile_id) WHERE status = 'ok'""",
        ),
        "tile_info": s(["ocean"], "SELECT tile_id, terrain_bytes, CASE WHEN terrain_bytes > 1 THEN terrain_bytes // 2 END AS node_count, is_ocean FROM ocean"),
        "scan_problem_tiles": s(["problems"], "SELECT * FROM problems"),
        "rebake_rounds": s(["problems", "states"], f"SELECT tile_lat, tile_lon, status, CAST(1 + (row_number() OVER (ORDER BY {NAME}) - 1) // 2000 AS INT) AS round FROM problems JOIN states USING (tile_lat, tile_lon)"),
        "bake_tiles": s(
            ["statuses", "payloads"],
            """SELECT tile_id, s.status, CASE WHEN s.status = 'ok' THEN t_nodes ELSE 0 END AS terrain_nodes, CASE WHEN s.status = 'ok' THEN p_nodes ELSE 0 END AS population_nodes,
  md5(CASE s.status WHEN 'ok' THEN t_hex WHEN 'no_data' THEN NULL ELSE 'FF' END) AS terrain_digest, md5(CASE s.status WHEN 'ok' THEN p_hex WHEN 'no_data' THEN NULL ELSE 'FF' END) AS population_digest FROM statuses s LEFT JOIN payloads USING (tile_id)""",
        ),
        "root_sizes": s(["states", "payloads"], "SELECT tile_id, CASE WHEN status = 'ok' THEN t_nodes END AS terrain_root, CASE WHEN status = 'ok' THEN p_nodes END AS population_root FROM states LEFT JOIN payloads USING (tile_id)"),
        "read_tile_dir": s(["files_of"], "SELECT tile_lat, tile_lon, bytes, digest FROM files_of"),
        "read_pack_tiles": s(["files_of"], "SELECT 'terrain' AS kind, tile_lat, tile_lon, bytes, digest FROM files_of"),
        "read_pack_source": s(["files_of"], "SELECT 'terrain' AS kind, tile_lat, tile_lon, bytes, digest FROM files_of WHERE tile_lat >= -20 AND tile_lat < 40"),
        "validate_payloads": s(["files_of"], "SELECT tile_lat, tile_lon, CASE tile_id % 5 WHEN 2 THEN 'odd byte count' WHEN 3 THEN 'structure' ELSE 'root is a leaf' END AS error FROM files_of WHERE tile_id % 5 BETWEEN 2 AND 4 AND bytes > 1"),
        "budget_cuts": s(
            ["budgets", "t_cuts", "p_cuts"],
            "SELECT tile_id, t_nodes, p_nodes, t_budget, p_budget, tile_id IN (SELECT tile_id FROM t_cuts) AS t_cut, tile_id IN (SELECT tile_id FROM p_cuts) AS p_cut FROM budgets",
        ),
        "resample_linear": s(
            ["whole"],
            """SELECT tile_id, g.r, g.c, round((1 - dc) * ((1 - dr) * a.dem + dr * b.dem) + dc * ((1 - dr) * e.dem + dr * f.dem), 6) AS dem, size FROM (
  SELECT tile_id, size, CAST(i AS INT) AS r, CAST(j AS INT) AS c, least(CAST(floor(y) AS INT), 30) AS r0, least(CAST(floor(x) AS INT), 30) AS c0, y - least(floor(y), 30) AS dr, x - least(floor(x), 30) AS dc FROM (
  SELECT tile_id, size, i, j, i * (31.0::DOUBLE / (size - 1)) AS y, j * (31.0::DOUBLE / (size - 1)) AS x FROM (SELECT DISTINCT tile_id FROM whole WHERE dem IS NOT NULL) CROSS JOIN (VALUES (12), (45)) AS s(size) CROSS JOIN range(45) AS p(i) CROSS JOIN range(45) AS q(j) WHERE i < size AND j < size)) g
  JOIN whole a USING (tile_id) JOIN whole b USING (tile_id) JOIN whole e USING (tile_id) JOIN whole f USING (tile_id)
  WHERE a.r = r0 AND a.c = c0 AND b.r = r0 + 1 AND b.c = c0 AND e.r = r0 AND e.c = c0 + 1 AND f.r = r0 + 1 AND f.c = c0 + 1""",
        ),
        "urban_pop_mismatch": s(["urban_bad"], "SELECT * FROM urban_bad"),
        "water_pop_mismatch": s(["samples"], "SELECT tile_lat, tile_lon, count(*) FILTER (density >= 1) AS hits, max(density) AS max_pop FROM samples WHERE NOT is_water AND zone = 0 AND density IS NOT NULL GROUP BY tile_lat, tile_lon HAVING count(*) FILTER (density >= 1) > 0"),
        "top_mismatches": s(["urban_bad"], "SELECT * FROM urban_bad ORDER BY max_pop DESC, tile_lat, tile_lon LIMIT 20"),
        "top_city_mismatches": s(["city_bad"], "SELECT * FROM city_bad ORDER BY p DESC, city_id LIMIT 30"),
        "city_mismatch": s(["city_bad"], "SELECT city_id, n, zone, density, urban, issues FROM city_bad"),
        "verify_cities": s(["verified"], "SELECT city_id, n, status, CASE WHEN status IN ('missing_tile', 'no_data') THEN -1 ELSE zone END AS zone, CASE WHEN status IN ('missing_tile', 'no_data') THEN -1 ELSE elevation END AS elevation, CASE WHEN status IN ('missing_tile', 'no_data') THEN 0 ELSE density END AS density FROM verified"),
        "city_status_counts": s(["verified"], "SELECT status, count(*) AS cities FROM verified GROUP BY status"),
        "coastal_problem_tiles": s(
            ["keyed", "states", "leaf_t", "leaf_p"],
            f"""SELECT k.tile_lat, k.tile_lon, string_agg(n, ',' ORDER BY n) AS names FROM keyed k JOIN (
  SELECT g.tile_lat, g.tile_lon FROM (SELECT DISTINCT tile_lat, tile_lon, 0.5 AS frac_lat, 0.5 AS frac_lon FROM states WHERE status = 'ok') g JOIN leaf_t t ON {AT.format(x="t")} JOIN leaf_p p ON {AT.format(x="p")} WHERE zone = 0 AND density > 0) b USING (tile_lat, tile_lon) WHERE NOT (la = 0 AND lo = 0) GROUP BY k.tile_lat, k.tile_lon""",
        ),
        "validate_tiles": s(["ocean"], "SELECT tile_lat, tile_lon, CASE WHEN terrain_bytes <= 1 THEN 'water tile on land' ELSE 'data tile in ocean' END AS issue FROM ocean WHERE (terrain_bytes <= 1) <> is_ocean"),
        "density_p99": s(["samples"], "SELECT greatest(1.0::DOUBLE, coalesce(quantile_cont(CAST(density AS DOUBLE), 0.99), 1.0)) AS p99 FROM samples"),
        "pack_layout": s(["tile_files"], f"SELECT {NAME} AS name, CAST((tile_lat + 90) * 360 + tile_lon + 180 AS INT) AS tile_idx, CAST(coalesce(sum(terrain_bytes) OVER (ORDER BY {NAME} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\", terrain_bytes AS size FROM tile_files"),
        "pack_header": s(["tile_files"], "SELECT count(*) AS tiles, CAST(sum(terrain_bytes) AS BIGINT) AS stored_bytes, CAST(sum(terrain_bytes) AS BIGINT) AS raw_bytes, CAST(sum(terrain_bytes) + 1036832 AS BIGINT) AS file_bytes, sum(terrain_bytes) + 1036832 > 1073741824 AS too_large FROM tile_files"),
        "top_largest": s(["tile_files"], f"SELECT {NAME} AS name, terrain_bytes FROM tile_files WHERE terrain_bytes > 1 ORDER BY terrain_bytes DESC, name LIMIT 10"),
        "new_tiles": s(["tile_files", "pack_a"], "SELECT tile_id, tile_lat, tile_lon FROM tile_files WHERE (tile_lat, tile_lon) NOT IN (SELECT (tile_lat, tile_lon) FROM pack_a)"),
        "incremental_pack": s(["pack_a", "pack_b"], "SELECT coalesce(a.tile_lat, b.tile_lat) AS tile_lat, coalesce(a.tile_lon, b.tile_lon) AS tile_lon, coalesce(b.size, a.size) AS size, CASE WHEN a.size IS NULL THEN 'new' WHEN b.size IS NULL OR a.size = b.size THEN 'same' ELSE 'changed' END AS change FROM pack_a a FULL JOIN pack_b b ON a.tile_lat = b.tile_lat AND a.tile_lon = b.tile_lon"),
        "merge_packs": s(["pack_a", "pack_b"], "SELECT * FROM pack_a UNION ALL SELECT * FROM pack_b b WHERE NOT EXISTS (SELECT 1 FROM pack_a a WHERE a.tile_lat = b.tile_lat AND a.tile_lon = b.tile_lon)"),
        "pack_shards": s(["tile_files"], f"{_shards('terrain', 'terrain_bytes')} UNION ALL {_shards('population', 'pop_bytes')}"),
        "shard_manifest": s(
            ["tile_files"],
            """SELECT 'GeoShard' AS format, 1 AS version, 10 AS shard_degrees, 36 AS header_bytes, 8 AS index_entry_bytes, CASE WHEN bool_or(stored < raw) THEN 'zstd-per-tile' ELSE 'none' END AS compression, count(*) AS shards, CAST(sum(n) AS BIGINT) AS tile_count, CAST(sum(stored) AS BIGINT) AS data_bytes, CAST(sum(raw) AS BIGINT) AS raw_bytes, CAST(sum(836 + stored) AS BIGINT) AS file_bytes
  FROM (SELECT floor((tile_lat + 90) / 10) AS a, floor((tile_lon + 180) / 10) AS b, count(*) AS n, sum(terrain_bytes * 3 // 5 + 1) AS stored, sum(terrain_bytes) AS raw FROM tile_files WHERE terrain_bytes IS NOT NULL GROUP BY 1, 2)""",
        ),
        "shard_blobs": s(
            ["laid"],
            f"""SELECT path, CAST(0 AS INT) AS seq, CAST(0 AS BIGINT) AS at, CAST(836 AS BIGINT) AS bytes, md5(concat('47534831', '0100', '0100', {_le("lon0", 2)}, {_le("lat0", 2)}, '0A000A00', {_le("count(*)", 4)}, '20030000', {_le("sum(n)", 4)}, {_le("sum(n)", 4)}, '00000000',
  (SELECT string_agg(coalesce((SELECT concat({_le("y.begin", 4)}, {_le("y.n", 4)}) FROM laid y WHERE y.path = l.path AND y.place = i), '0000000000000000'), '' ORDER BY i) FROM range(100) AS r(i)))) AS digest FROM laid l GROUP BY path, lon0, lat0
  UNION ALL SELECT path, CAST(seq AS INT), CAST(836 + begin AS BIGINT), n, md5(digits) FROM laid""",
        ),
        "deep_terrain_leaves": s(["deep_t"], f"SELECT tile_id, path, CAST(level AS INT) AS level, round(mean, 6) AS elev, {ZONE_OF_BLOCK} AS zone, CASE WHEN grad < 10 THEN 0 WHEN grad < 50 THEN 1 WHEN grad < 200 THEN 2 ELSE 3 END AS gradient FROM deep_t WHERE NOT t_split"),
        "deep_population_leaves": s(
            ["deep_p"],
            """SELECT tile_id, path, CAST(level AS INT) AS level, round(people, 6) AS density, CASE WHEN mode <> 0 THEN mode WHEN people > 5000 THEN 2 WHEN people > 10 THEN 1 ELSE 0 END AS urban FROM (
  SELECT *, (SELECT u FROM (SELECT u, len(list_filter(towns, lambda x: x = u)) AS k FROM range(8) AS r(u)) ORDER BY k DESC, u LIMIT 1) AS mode FROM deep_p WHERE NOT p_split)""",
        ),
        "deep_tree_sizes": s(["deep_t", "deep_p"], "SELECT tile_id, t_nodes, p_nodes, 2 * t_nodes AS t_bytes, 2 * p_nodes AS p_bytes FROM (SELECT tile_id, CAST(count(*) AS INT) AS t_nodes FROM deep_t GROUP BY tile_id) JOIN (SELECT tile_id, CAST(count(*) AS INT) AS p_nodes FROM deep_p GROUP BY tile_id) USING (tile_id)"),
        "incremental_payloads": s(
            ["laid"],
            """SELECT tile_lat, tile_lon, md5(CASE WHEN tile_id % 2 = 0 AND tile_id % 4 = 0 AND n > 1 THEN concat(left(digits, length(digits) - 2), '00') ELSE digits END) AS digest,
  CASE WHEN tile_id % 3 = 0 THEN 'new' WHEN tile_id % 4 = 0 AND n > 1 AND right(digits, 2) <> '00' THEN 'changed' ELSE 'same' END AS change FROM laid WHERE tile_id % 3 <> 0 OR tile_id % 2 = 0""",
        ),
        "fix_ocean": s(["ocean"], "SELECT tile_id, CASE WHEN is_ocean AND terrain_bytes > 1 THEN 1 ELSE terrain_bytes END AS terrain_bytes, CASE WHEN is_ocean AND terrain_bytes > 1 AND pop_bytes IS NOT NULL THEN 1 ELSE pop_bytes END AS pop_bytes FROM ocean"),
        "land_index": s(["footprints"], "SELECT DISTINCT CAST(i AS INT) AS tile_lat, CAST(j AS INT) AS tile_lon FROM footprints JOIN range(-90, 90) AS a(i) ON i BETWEEN floor(lat_min) AND ceil(lat_max) JOIN range(-180, 180) AS b(j) ON j BETWEEN floor(lon_min) AND ceil(lon_max)"),
        "bake_log_stream": s(["bake_log"], "SELECT status, count(*) AS tiles, CAST(sum(CASE WHEN status = 'ok' THEN nodes ELSE 0 END) AS BIGINT) AS ok_nodes, CAST(sum(download_ms) AS BIGINT) AS download_ms FROM bake_log GROUP BY status"),
    }
    return out
