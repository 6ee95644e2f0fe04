"""Pack files: an index of all cells and a compressed blob per tile."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.keys import HEIGHT, WIDTH, shard_origin
from ..operators.pack import PACK_ENTRY_BYTES, PACK_HEADER, PACK_HEADER_BYTES, PACK_MAGIC

INDEX_BYTES = PACK_ENTRY_BYTES * WIDTH * HEIGHT


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it of a URI or a local path."""
    parts = urlsplit(path)
    return (fs.LocalFileSystem(), parts.path) if parts.scheme in ("", "file") else fs.FileSystem.from_uri(path)


def read_pack_tiles(spark: SparkSession, path: str, frame_bytes: int = 16 << 20) -> DataFrame:
    """kind, tile_lat, tile_lon and payload of the tiles of pack files.

    Each file's index is read whole, its blobs one after another; frames hold ``frame_bytes``.
    """
    fields = "kind string, tile_lat int, tile_lon int, payload binary"
    names = [c.split()[0] for c in fields.split(", ")]

    def read(name: str) -> Iterator[pd.DataFrame]:
        store, at = _store(name)
        with store.open_input_file(at) as pack:
            magic, _, wide, _, _, _, _, flags, _ = struct.unpack(PACK_HEADER, pack.read(PACK_HEADER_BYTES))
            kind = {v: k for k, v in PACK_MAGIC.items()}.get(magic)
            if kind is None:
                raise ValueError("not a pack file")
            opened = bytes
            if flags & 1:
                import zstandard

                opened = zstandard.ZstdDecompressor().decompress
            index = np.frombuffer(pack.read(INDEX_BYTES), "<u8").reshape(-1, 2)
            cells = np.flatnonzero(index[:, 1])
            rows, held = [], 0
            for i in cells[np.argsort(index[cells, 0], kind="stable")].tolist():
                offset, size = index[i].tolist()
                rows.append((kind, i // wide - 90, i % wide - 180, opened(pack.read_at(size, PACK_HEADER_BYTES + INDEX_BYTES + offset))))
                held += len(rows[-1][3])
                if held >= frame_bytes:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name in f.path:
                yield from read(name)

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.dat").load(path).select("path").mapInPandas(run, fields)


def write_pack_parts(tiles: DataFrame, folder: str, kind: str = "terrain", degrees: int = 30) -> int:
    """Writes a pack file per square of ``degrees`` of the tiles (tile_lat, tile_lon, payload); returns how many tiles.

    Of several rows of a cell the longest payload, then the first in order, is packed; where tiles
    have a layer (see ``with_layer``), of each, and a layer has parts of its own. Each part
    has the whole index, so it can be read alone. Blobs go to the file as they come, and the header
    and index are known by then from their sizes alone; a repeated task writes the file anew.
    """

    layered = ["layer"] if "layer" in tiles.columns else []

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        packer, index, at, raw = zstandard.ZstdCompressor(level=9), np.zeros((WIDTH * HEIGHT, 2), "<u8"), 0, 0
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        part = f"{path}/.blobs-{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            for lat, lon, payload in zip(rows.tile_lat, rows.tile_lon, rows.payload, strict=True):
                blob = packer.compress(bytes(payload))
                index[(lat + 90) * WIDTH + lon + 180] = at, len(blob)
                at, raw = at + len(blob), raw + len(payload)
                out.write(blob)
        layer = f"_{key[2]}" if layered else ""
        with store.open_output_stream(f"{path}/part_{key[0]:+03d}_{key[1]:+04d}{layer}.dat") as out, store.open_input_stream(part) as blobs:
            out.write(struct.pack(PACK_HEADER, PACK_MAGIC[kind], 2, WIDTH, HEIGHT, len(rows), at, raw, 1, 0) + index.tobytes())
            while data := blobs.read(4 << 20):
                out.write(data)
        store.delete_file(part)
        return pd.DataFrame({"n": [len(rows)]})

    square = {"lat_0": shard_origin(F.col("tile_lat"), -90, degrees), "lon_0": shard_origin(F.col("tile_lon"), -180, degrees)}
    rows = tiles.filter("payload is not null").filter(F.col("tile_lat").between(-90, 89) & F.col("tile_lon").between(-180, 179))
    best = F.row_number().over(Window.partitionBy("tile_lat", "tile_lon", *layered).orderBy(F.desc(F.length("payload")), "payload"))
    rows = rows.select("tile_lat", "tile_lon", "payload", *layered, best.alias("_place")).filter("_place = 1").drop("_place").withColumns(square)
    return rows.groupBy("lat_0", "lon_0", *layered).applyInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
