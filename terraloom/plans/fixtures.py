"""Input views derived from the base tables; one text for Spark SQL and for the check's SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Base tables and other views that each view reads.
NEEDS = {"px": ["orders"], "px_deep": ["orders"], "tile_files": ["part"], "cities": ["customer"], "land_tiles": ["orders"], "footprints": ["supplier"], "bake_log": ["events"], "dem_candidates": ["part"], "tile_list_lines": ["part"], "pack_a": ["tile_files"], "pack_b": ["tile_files"]}
VIEWS = {
    "px": """
WITH b AS (
  SELECT o.o_orderkey * 16 + v.k AS pid, o.o_custkey AS ck,
         CAST(round(o.o_totalprice * 100) AS BIGINT) AS cents
  FROM orders o CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11),(12),(13),(14),(15)) AS v(k)),
g AS (
  SELECT CAST(floor(pid / 1024) AS BIGINT) AS t, CAST(floor((pid % 1024) / 32) AS INT) AS r,
         CAST(pid % 32 AS INT) AS c, pid, ck, cents FROM b)
SELECT t AS tile_id,
  CAST(floor(((t * 7919) % 64800) / 360) AS INT) - 90 AS tile_lat,
  CAST((t * 7919) % 360 AS INT) - 180 AS tile_lon, r, c,
  CASE WHEN t % 11 = 0 THEN NULL
       WHEN t % 5 = 0 THEN CAST(0 AS DOUBLE)
       WHEN t % 5 = 1 AND c < 12 THEN CAST(0 AS DOUBLE)
       WHEN t % 5 = 2 THEN CAST(20 + (cents + pid) % 3 AS DOUBLE)
       ELSE CAST((t * 613) % 7600 + r * 3 + c * 2 + (cents + pid * 7) % (1 + (t % 4) * 60) AS DOUBLE) END AS dem,
  CASE WHEN t % 13 = 0 THEN NULL
       WHEN r BETWEEN 8 AND 15 AND c BETWEEN 8 AND 15 THEN CAST((ck * 37 + pid) % 6000 AS DOUBLE)
       ELSE CAST((ck + pid) % 12 AS DOUBLE) END AS pop,
  CASE WHEN t % 7 = 6 THEN NULL
       WHEN t % 5 = 0 THEN 80
       WHEN t % 5 = 1 AND c < 12 THEN 80
       WHEN t % 5 = 3 AND r < 10 THEN 10
       WHEN r BETWEEN 8 AND 15 AND c BETWEEN 8 AND 15 THEN 50
       WHEN t % 5 = 4 AND c > 20 THEN 70
       WHEN t % 5 = 3 AND c > 28 THEN 80
       WHEN r > 28 THEN 101
       ELSE 30 END AS esa
FROM g
""",
    "px_deep": """
WITH b AS (
  SELECT o.o_orderkey * 16 + v.k AS pid, o.o_custkey AS ck
  FROM orders o CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11),(12),(13),(14),(15)) AS v(k)),
g AS (
  SELECT CAST(floor(pid / 4096) AS BIGINT) AS t, CAST(floor((pid % 4096) / 64) AS INT) AS r,
         CAST(pid % 64 AS INT) AS c, pid, ck FROM b)
SELECT t AS tile_id, CAST(t % 180 AS INT) - 90 AS tile_lat, CAST(t % 360 AS INT) - 180 AS tile_lon, r, c,
  CASE WHEN t % 4 = 0 THEN CAST(40 AS DOUBLE)
       WHEN t % 4 = 1 THEN CAST(40 + (pid * 7) % (2 + floor(r / 8) * 2) AS DOUBLE)
       WHEN t % 4 = 2 THEN CAST(900 + r * 3 + floor(c / 16) * 40 AS DOUBLE)
       WHEN c < 21 THEN CAST(0 AS DOUBLE) ELSE CAST((pid * 13) % 4 AS DOUBLE) END AS dem,
  CASE WHEN t % 3 = 0 THEN CASE WHEN r = 21 AND c = 12 THEN CAST(4000 AS DOUBLE) WHEN r = 50 AND c > 40 THEN CAST(30 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
       WHEN t % 3 = 1 THEN CAST((ck + pid) % (1 + floor(c / 4)) AS DOUBLE)
       ELSE CAST(12 AS DOUBLE) END AS pop,
  CASE WHEN t % 4 = 3 AND c < 21 THEN 0 WHEN t % 5 = 0 THEN 1 + CAST(floor(c / 9) + floor(r / 4) AS INT) % 3 WHEN t % 5 = 1 AND r > 30 THEN 3 ELSE 1 END AS zone,
  CASE WHEN t % 3 = 2 THEN CAST(floor((c + r / 3) / 11) AS INT) % 4 WHEN t % 3 = 0 AND r < 9 THEN 5 ELSE 0 END AS urban
FROM g
""",
    "tile_files": """
SELECT p_partkey AS tile_id,
  CAST(floor(((p_partkey * 7919) % 64800) / 360) AS INT) - 90 AS tile_lat,
  CAST((p_partkey * 7919) % 360 AS INT) - 180 AS tile_lon,
  CASE WHEN p_partkey % 4 = 0 THEN 1
       ELSE 2 * (1 + ((p_partkey * p_partkey * 31) % 30000) %
         (CASE p_partkey % 5 WHEN 0 THEN 400 WHEN 1 THEN 4000 ELSE 30000 END)) END AS terrain_bytes,
  CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN 1
       ELSE 2 * (1 + (p_partkey * 17) % 9000) END AS pop_bytes
FROM part
""",
    "cities": """
SELECT c_custkey AS city_id, c_name AS n,
  CASE WHEN c_custkey % 50 = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(floor((((c_custkey % 260) * 7919) % 64800) / 360) - 90 AS DOUBLE)
            + CAST((c_custkey * 104729) % 4096 AS DOUBLE) / 4096 END AS la,
  CASE WHEN c_custkey % 50 = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(((c_custkey % 260) * 7919) % 360 - 180 AS DOUBLE)
            + CAST((c_custkey * 130363) % 4096 AS DOUBLE) / 4096 END AS lo,
  round(c_acctbal * 10) AS p
FROM customer
""",
    "land_tiles": """
SELECT CAST(floor(((o_orderkey * 7919) % 64800) / 360) AS INT) - 90 AS tile_lat,
       CAST((o_orderkey * 7919) % 360 AS INT) - 180 AS tile_lon
FROM orders WHERE o_orderkey < 64800 AND o_orderkey % 10 < 9
""",
    "footprints": """
SELECT s_suppkey AS item_id,
  CAST((s_suppkey * 37) % 350 - 175 AS DOUBLE) + CAST(s_suppkey % 4 AS DOUBLE) / 4 AS lon_min,
  CAST((s_suppkey * 17) % 170 - 85 AS DOUBLE) + CAST(s_suppkey % 2 AS DOUBLE) / 2 AS lat_min,
  CAST((s_suppkey * 37) % 350 - 172 AS DOUBLE) + CAST(s_suppkey % 4 AS DOUBLE) / 4 AS lon_max,
  CAST((s_suppkey * 17) % 170 - 82 AS DOUBLE) + CAST(s_suppkey % 2 AS DOUBLE) / 2 AS lat_max
FROM supplier
""",
    "bake_log": """
SELECT event_id AS idx,
  CAST(floor((((event_id % 400) * 7919) % 64800) / 360) AS INT) - 90 AS tile_lat,
  CAST(((event_id % 400) * 7919) % 360 AS INT) - 180 AS tile_lon,
  CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'water' WHEN 'purchase' THEN 'ocean'
                  WHEN 'signup' THEN 'no_data' ELSE 'error' END AS status,
  CASE WHEN event_type = 'view' THEN (event_id * 31) % 24000 ELSE 0 END AS nodes,
  CAST(round(value * 700) AS BIGINT) AS download_ms,
  CAST(round(value * 300) AS BIGINT) AS quadtree_ms,
  ts
FROM events
""",
    "dem_candidates": """
SELECT p.p_partkey AS tile_id, s.prio,
  CASE WHEN (p.p_partkey + s.prio) % 3 = 0 THEN 0
       WHEN (p.p_partkey * 7 + s.prio) % 4 = 1 THEN NULL ELSE 1024 END AS n_px,
  CAST(CASE WHEN (p.p_partkey + s.prio) % 5 = 0 THEN 0 ELSE p.p_size END AS DOUBLE) AS v_min,
  CAST(CASE WHEN (p.p_partkey + s.prio) % 5 = 0 THEN 0 ELSE p.p_size * 40 END AS DOUBLE) AS v_max
FROM part p CROSS JOIN (VALUES (1),(2),(3)) AS s(prio)
""",
    "tile_list_lines": """
SELECT p_partkey AS line_no,
  CASE p_partkey % 7
    WHEN 0 THEN '# skipped'
    WHEN 1 THEN concat(CAST(p_partkey % 360 - 180 AS VARCHAR(20)), ',', CAST(p_partkey % 180 - 90 AS VARCHAR(20)), ',30017')
    WHEN 2 THEN concat(CAST(p_partkey % 360 - 180 AS VARCHAR(20)), ' ', CAST(p_partkey % 180 - 90 AS VARCHAR(20)))
    WHEN 3 THEN concat('  ', CAST(p_partkey % 360 - 180 AS VARCHAR(20)), ' , ', CAST(p_partkey % 180 - 90 AS VARCHAR(20)), ' ')
    WHEN 4 THEN 'bad,line'
    WHEN 5 THEN '12'
    ELSE '' END AS line
FROM part
""",
    "pack_a": """
SELECT tile_lat, tile_lon, terrain_bytes AS size FROM tile_files WHERE tile_id % 3 <> 0
""",
    "pack_b": """
SELECT tile_lat, tile_lon, terrain_bytes + 2 AS size FROM tile_files WHERE tile_id % 2 = 0
""",
}


#: Pixels that a task holds; an order has 16, and 64 orders in a row of keys a tile.
TASK_PIXELS = 1 << 20


def pixel_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions for the pixels of a folder; their number grows with the table, so that tasks don't."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    return max(spark.sparkContext.defaultParallelism, -(-orders * 16 // TASK_PIXELS))


def dealt_view(spark: SparkSession, sf_dir: str, name: str, parts: int) -> DataFrame:
    """A view of pixels whose orders are dealt into ``parts`` before each becomes 16 rows."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(parts, F.floor(F.col("o_orderkey") / 64))
    orders.createOrReplaceTempView("orders")
    return spark.sql(VIEWS[name])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view's rows over the tables in a folder."""
    for need in NEEDS[name]:
        source = view(spark, sf_dir, need) if need in VIEWS else spark.read.parquet(f"{sf_dir}/{need}.parquet")
        source.createOrReplaceTempView(need)
    return spark.sql(VIEWS[name])


def with_views(*names: str) -> str:
    """The views as the head of a statement: WITH a AS (...), b AS (...)"""
    wanted: list[str] = []
    for n in names:
        wanted += [k for k in NEEDS[n] if k in VIEWS and k not in wanted]
        wanted += [n] if n not in wanted else []
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
