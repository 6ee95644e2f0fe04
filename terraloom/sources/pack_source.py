"""A Spark data source for pack files: parts of one file go to several tasks, filters on cells spare the blobs."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions.keys import HEIGHT, WIDTH
from ..operators.pack import PACK_ENTRY_BYTES, PACK_HEADER, PACK_HEADER_BYTES, PACK_MAGIC
from .packs import INDEX_BYTES, _store

FIELDS = "kind string, tile_lat int, tile_lon int, payload binary"
#: Rows of the grid whose index entries one task reads.
ROWS_PER_TASK = 15
LIMITS = {GreaterThan: (1, 0), GreaterThanOrEqual: (0, 0), LessThan: (0, -1), LessThanOrEqual: (0, 0)}


@dataclass
class Rows(InputPartition):
    """Grid rows ``low`` to ``high`` - 1 of the index of a file."""

    path: str
    low: int
    high: int


class PackSource(DataSource):
    """``spark.read.format("tilepack").load(folder)``: kind, tile_lat, tile_lon and payload of all tiles."""

    @classmethod
    def name(cls) -> str:
        return "tilepack"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> PackReader:
        return (FilteringPackReader if self.options.get("pushdown") == "true" else PackReader)(self.options)


class PackReader(DataSourceReader):
    """Plans ranges of grid rows without reading a file; a task reads its part of the index and the blobs it wants."""

    def __init__(self, options: dict):
        self.folder, self.rows = options["path"], int(options.get("rowspertask", ROWS_PER_TASK))
        self.bounds = {"tile_lat": [-90, 89], "tile_lon": [-180, 179]}
        self.cells: dict[str, set[int]] = {}

    def _wants(self, name: str, value: int) -> bool:
        low, high = self.bounds[name]
        return low <= value <= high and (name not in self.cells or value in self.cells[name])

    def partitions(self) -> list[Rows]:
        from pyarrow import fs

        store, at = _store(self.folder)
        found = [f.path for f in store.get_file_info(fs.FileSelector(at)) if f.path.endswith(".dat")]
        lats = [n for n in range(HEIGHT) if self._wants("tile_lat", n - 90)]
        spans = [(k, min(HEIGHT, k + self.rows)) for k in range(0, HEIGHT, self.rows) if any(k <= n < k + self.rows for n in lats)]
        return [Rows(path, *span) for path in sorted(found) for span in spans] or [Rows("", 0, 0)]

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        schema = pa.schema([("kind", pa.string()), ("tile_lat", pa.int32()), ("tile_lon", pa.int32()), ("payload", pa.binary())])
        store, _ = _store(self.folder)
        with store.open_input_file(part.path) as pack:
            magic, *_, flags, _ = struct.unpack(PACK_HEADER, pack.read_at(PACK_HEADER_BYTES, 0))
            kind = {v: k for k, v in PACK_MAGIC.items()}.get(magic)
            if kind is None:
                raise ValueError("not a pack file")
            opened = bytes
            if flags & 1:
                import zstandard

                opened = zstandard.ZstdDecompressor().decompress
            begin = part.low * WIDTH
            index = np.frombuffer(pack.read_at((part.high - part.low) * WIDTH * PACK_ENTRY_BYTES, PACK_HEADER_BYTES + begin * PACK_ENTRY_BYTES), "<u8").reshape(-1, 2)
            for i in np.flatnonzero(index[:, 1]).tolist():
                lat, lon = (begin + i) // WIDTH - 90, (begin + i) % WIDTH - 180
                if self._wants("tile_lat", lat) and self._wants("tile_lon", lon):
                    offset, size = index[i].tolist()
                    payload = opened(pack.read_at(size, PACK_HEADER_BYTES + INDEX_BYTES + offset))
                    yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((kind, lat, lon, payload), schema, strict=True)], schema=schema)


class FilteringPackReader(PackReader):
    """The reader for sessions in which Python sources are given filters (Spark refuses it in others)."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of a cell's row or column with whole numbers, gives the others back."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if name in self.bounds and isinstance(f, (EqualTo, In)):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.cells[name] = self.cells.get(name, wanted) & wanted
            elif name in self.bounds and type(f) in LIMITS:
                up, down = LIMITS[type(f)]
                low, high = self.bounds[name]
                self.bounds[name] = [max(low, f.value + up), high] if isinstance(f, (GreaterThan, GreaterThanOrEqual)) else [low, min(high, f.value + down)]
            else:
                yield f


def read_packs(spark: SparkSession, folder: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The tiles of all pack files of a folder; filters on tile_lat and tile_lon reach the source where ``spark.sql.python.filterPushdown.enabled`` is set."""
    spark.dataSource.register(PackSource)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("tilepack").option("rowsPerTask", rows_per_task).option("pushdown", pushed).load(folder)
