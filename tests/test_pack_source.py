"""The pack source: several tasks for one file, and filters that spare blobs."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThanOrEqual, StringContains

from terraloom.sources import packs
from terraloom.sources.pack_source import FilteringPackReader, read_packs


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    random = np.random.default_rng(9)
    cells = {(int(a), int(b)) for a, b in zip(random.integers(-90, 90, 300), random.integers(-180, 180, 300), strict=True)} | {(-90, -180), (89, 179)}
    rows = [(a, b, bytearray(random.bytes(int(random.integers(1, 200))))) for a, b in sorted(cells)]
    tiles = spark.createDataFrame(rows, "tile_lat int, tile_lon int, payload binary")
    folder = str(tmp_path_factory.mktemp("packs"))
    packs.write_pack_parts(tiles, folder, degrees=180)
    return tiles, folder


def test_rows_equal_what_was_written_by_many_tasks(spark, packed):
    tiles, folder = packed
    found = read_packs(spark, folder)
    assert found.rdd.getNumPartitions() == 2 * 12 and found.select("kind").distinct().collect() == [("terrain",)]
    back = found.drop("kind")
    assert back.exceptAll(tiles).count() == 0 and back.count() == tiles.count()
    assert len([n for n in found.groupBy(F.spark_partition_id()).count().collect() if n["count"]]) > 12
    assert back.exceptAll(packs.read_pack_tiles(spark, folder).drop("kind")).count() == 0


def test_filters_on_cells_read_their_blobs_alone(spark, packed):
    tiles, folder = packed
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for rule in ("tile_lat = 89", "tile_lat > 40 and tile_lat <= 47 and tile_lon >= 0", "tile_lon in (-180, 5, 179) and payload is not null", "tile_lat < -200", "tile_lat + tile_lon > 20"):
            got, want = read_packs(spark, folder).filter(rule).drop("kind"), tiles.filter(rule)
            assert got.exceptAll(want).count() == 0 and got.count() == want.count()
        assert read_packs(spark, folder).filter("tile_lat = 89").rdd.getNumPartitions() == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_reader_reads_no_blob_that_a_filter_leaves_out(packed, monkeypatch):
    from terraloom.sources import pack_source

    reads = []

    class Counting:
        def __init__(self, file):
            self.file = file

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.file.close()

        def read_at(self, size, offset):
            reads.append(offset)
            return self.file.read_at(size, offset)

    real = pack_source._store

    class Store:
        def __init__(self, store):
            self.store = store

        def open_input_file(self, path):
            return Counting(self.store.open_input_file(path))

        def get_file_info(self, selector):
            return self.store.get_file_info(selector)

    monkeypatch.setattr(pack_source, "_store", lambda path: (Store(real(path)[0]), real(path)[1]))
    reader = FilteringPackReader({"path": packed[1]})
    left = list(reader.pushFilters([EqualTo(("tile_lat",), 89), In(("tile_lon",), (179, 3)), GreaterThan(("tile_lon",), 100), LessThanOrEqual(("tile_lat",), 89), StringContains(("kind",), "t")]))
    assert [type(f) for f in left] == [StringContains]
    rows = [b.to_pylist()[0] for p in reader.partitions() for b in reader.read(p)]
    assert [(r["tile_lat"], r["tile_lon"]) for r in rows] == [(89, 179)]
    blobs = [o for o in reads if o >= packs.INDEX_BYTES]
    assert len(blobs) == 1 and len(reader.partitions()) == 2
