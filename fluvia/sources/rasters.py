"""GeoTIFF files as tables of cells and back: little-endian, strips or tiles, plain or deflated, one or more bands."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: tags, field types (size, struct code), sample types.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, TILE_W, TILE_H, TILE_AT, TILE_N, KIND, SCALE, TIE, NODATA = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 322, 323, 324, 325, 339, 33550, 33922, 42113
TYPES = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 11: (4, "f"), 12: (8, "d"), 16: (8, "Q")}
KINDS = {1: "u", 2: "i", 3: "f"}
PLAIN, DEFLATE, ADOBE_DEFLATE = 1, 32946, 8


def tags_of(data: bytes) -> dict[int, tuple]:
    """Tags of a file's first image."""
    if data[:4] != b"II*\0":
        raise ValueError("not a little-endian TIFF file")
    at = struct.unpack_from("<I", data, 4)[0]
    out = {}
    for k in range(struct.unpack_from("<H", data, at)[0]):
        tag, kind, n = struct.unpack_from("<HHI", data, at + 2 + 12 * k)
        size, code = TYPES.get(kind, (1, "B"))
        place = at + 2 + 12 * k + 8
        if size * n > 4:
            place = struct.unpack_from("<I", data, place)[0]
        out[tag] = (data[place : place + n].rstrip(b"\0"),) if code == "s" else struct.unpack_from(f"<{n}{code}", data, place)
    return out


def bands_of(data: bytes) -> tuple[np.ndarray, tuple[float, float, float], float | None]:
    """Values (band, row, col), the grid (x0, y0, cell size), and the value that stands for none."""
    t = tags_of(data)
    width, height, n = t[WIDTH][0], t[HEIGHT][0], t.get(SAMPLES, (1,))[0]
    kind = np.dtype(f"<{KINDS[t.get(KIND, (1,))[0]]}{t.get(BITS, (8,))[0] // 8}")
    apart = t.get(PLANAR, (1,))[0] == 2
    tiled = TILE_AT in t
    bw, bh = (t[TILE_W][0], t[TILE_H][0]) if tiled else (width, t.get(ROWS, (height,))[0])
    across, down = -(-width // bw), -(-height // bh)
    places, sizes = (t[TILE_AT], t[TILE_N]) if tiled else (t[OFFSETS], t[COUNTS])
    out = np.zeros((n, height, width), kind)
    for k, (p, size) in enumerate(zip(places, sizes, strict=True)):
        raw = data[p : p + size]
        if t.get(COMPRESSION, (PLAIN,))[0] in (DEFLATE, ADOBE_DEFLATE):
            raw = zlib.decompress(raw)
        elif t.get(COMPRESSION, (PLAIN,))[0] != PLAIN:
            raise ValueError("only plain and deflated files are read")
        band, k = divmod(k, across * down) if apart else (slice(None), k)
        r, c = k // across * bh, k % across * bw
        rows = bh if tiled else min(bh, height - r)
        block = np.frombuffer(raw, kind, rows * bw * (1 if apart else n)).reshape(rows, bw, -1)
        piece = block[: height - r, : width - c]
        if apart:
            out[band, r : r + piece.shape[0], c : c + piece.shape[1]] = piece[:, :, 0]
        else:
            out[:, r : r + piece.shape[0], c : c + piece.shape[1]] = piece.transpose(2, 0, 1)
    scale, tie = t.get(SCALE, (1.0, 1.0, 0.0)), t.get(TIE, (0.0,) * 6)
    none = float(t[NODATA][0]) if NODATA in t else None
    return out, (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0]), none


def file_of(bands: np.ndarray, x0: float, y0: float, res: float, nodata: float | None = None) -> bytes:
    """A deflated file of values (band, row, col), a strip for each band and run of rows."""
    n, height, width = bands.shape
    rows = max(1, min(height, (1 << 20) // max(1, width * bands.itemsize)))
    strips = [zlib.compress(np.ascontiguousarray(b[r : r + rows].astype(bands.dtype.newbyteorder("<"))).tobytes()) for b in bands for r in range(0, height, rows)]
    kind = {v: k for k, v in KINDS.items()}[bands.dtype.kind]
    body, offsets = b"", []
    for s in strips:
        offsets.append(8 + len(body))
        body += s + b"\0" * (len(s) % 2)
    fields = [
        (WIDTH, 4, (width,)), (HEIGHT, 4, (height,)), (BITS, 3, (bands.itemsize * 8,) * n), (COMPRESSION, 3, (ADOBE_DEFLATE,)), (PHOTOMETRIC, 3, (1,)), (OFFSETS, 4, tuple(offsets)), (SAMPLES, 3, (n,)), (ROWS, 4, (rows,)),
        (COUNTS, 4, tuple(map(len, strips))), (PLANAR, 3, (2,)), (KIND, 3, (kind,) * n), (SCALE, 12, (res, res, 0.0)), (TIE, 12, (0.0, 0.0, 0.0, x0, y0, 0.0)),
    ]
    if nodata is not None:
        fields.append((NODATA, 2, (f"{nodata:g}".encode() + b"\0",)))
    start = 8 + len(body)
    more, entries = b"", b""
    free = start + 2 + 12 * len(fields) + 4
    for tag, code, values in fields:
        size, letter = TYPES[code]
        raw = values[0] if letter == "s" else struct.pack(f"<{len(values)}{letter}", *values)
        count = len(raw) if letter == "s" else len(values)
        entries += struct.pack("<HHI", tag, code, count)
        if len(raw) <= 4:
            entries += raw.ljust(4, b"\0")
        else:
            entries += struct.pack("<I", free + len(more))
            more += raw + b"\0" * (len(raw) % 2)
    return b"II*\0" + struct.pack("<I", start) + body + struct.pack("<H", len(fields)) + entries + struct.pack("<I", 0) + more


def raster(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(file, row, col, x, y, a column for each name): band i is names[i]. What the file says is missing, and NaN, is NULL. A file is read by one task."""

    def run(frames) -> Iterator:
        import pandas as pd

        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                bands, (x0, y0, res), none = bands_of(bytes(content))
                for r in range(bands.shape[1]):
                    cells = {"file": name, "row": r, "col": range(bands.shape[2]), "x": x0 + (np.arange(bands.shape[2]) + 0.5) * res, "y": y0 - (r + 0.5) * res}
                    for k, c in enumerate(names):
                        v = bands[k, r].astype(float)
                        cells[c] = np.where(v == none, np.nan, v) if none is not None else v
                    yield pd.DataFrame(cells)

    kinds = "".join(f", `{c}` double" for c in names)
    got = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, f"file string, row int, col int, x double, y double{kinds}")
    return got.select("file", "row", "col", "x", "y", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in names])


def write_raster(cells: DataFrame, path: str, names: Sequence[str], x0: float, y0: float, res: float, tile: int = 1024, nodata: float = -9999.0) -> None:
    """A deflated file of float32 bands for each tile of the grid, as rows (tile_row, tile_col, content) of a Parquet table: tiles are independent, and the grid is in no one task."""

    def run(key, table):
        import pyarrow as pa

        r, c = np.asarray(table["row"]), np.asarray(table["col"])
        tr, tc = (k.as_py() for k in key)
        shape = int(r.max()) - tr * tile + 1, int(c.max()) - tc * tile + 1
        bands = np.full((len(names), *shape), nodata, np.float32)
        for k, n in enumerate(names):
            v = table[n].to_numpy(zero_copy_only=False).astype(float)
            bands[k, r - tr * tile, c - tc * tile] = np.where(np.isnan(v), nodata, v)
        return pa.table({"tile_row": pa.array([tr], pa.int32()), "tile_col": pa.array([tc], pa.int32()), "content": pa.array([file_of(bands, x0 + tc * tile * res, y0 - tr * tile * res, res, nodata)], pa.binary())})

    own = cells.select("row", "col", *[F.col(n).cast("double").alias(n) for n in names])
    tiles = own.withColumn("tile_row", F.expr(f"cast(row div {tile} as int)")).withColumn("tile_col", F.expr(f"cast(col div {tile} as int)"))
    tiles.groupBy("tile_row", "tile_col").applyInArrow(run, "tile_row int, tile_col int, content binary").write.parquet(path)
