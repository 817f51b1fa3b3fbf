"""Single-band float GeoTIFF rasters as tiles: strips or tiles, plain, deflate, LZW or packed bits, with predictors; geographic and north-up."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

# Tag numbers of the TIFF and GeoTIFF formats, and bytes of their field types.
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, BANDS, ROWS, COUNTS, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 322, 323, 324, 325, 339
PREDICTOR, SCALE, TIEPOINT, KEYS, NODATA = 317, 33550, 33922, 34735, 42113
_SIZES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 12: ("d", 8), 16: ("Q", 8)}


def _lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant first; 256 begins a new table, 257 ends."""
    out, at, held, size, i = [], 0, 0, 9, 0
    table: list[bytes] = []
    last = b""
    while True:
        while held < size:
            if i == len(raw):
                return b"".join(out)
            at, held, i = at << 8 | raw[i], held + 8, i + 1
        held -= size
        code = at >> held
        at &= (1 << held) - 1
        if code == 257:
            return b"".join(out)
        if code == 256:
            table, size, last = [bytes([b]) for b in range(256)] + [b"", b""], 9, b""
            continue
        if not table:
            raise ValueError("LZW data without a first table")
        text = table[code] if code < len(table) else last + last[:1]
        out.append(text)
        if last:
            table.append(last + text[:1])
        last = text
        size = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9


def _packed(raw: bytes) -> bytes:
    out, i = [], 0
    while i < len(raw):
        n = raw[i]
        if n < 128:
            out.append(raw[i + 1 : i + n + 2])
            i += n + 2
        else:
            out.append(raw[i + 1 : i + 2] * (257 - n) if n > 128 else b"")
            i += 2 if n > 128 else 1
    return b"".join(out)


_UNPACK = {1: bytes, 5: _lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: _packed}


@dataclass
class Grid:
    """Where the pixels of a raster lie, and how its file is cut into tiles."""

    path: str
    width: int
    height: int
    x0: float
    y0: float
    dx: float
    dy: float
    nodata: float | None
    tile: tuple[int, int]
    offsets: list[int]
    counts: list[int]
    compression: int
    order: str
    predictor: int = 1

    @property
    def across(self) -> int:
        return -(-self.width // self.tile[0])


def read_grid(path: str) -> Grid:
    """The first image's header; rasters with several bands, other samples, projected coordinates or point pixels are refused."""
    with open(path, "rb") as f:
        raw = f.read(8)
        if raw[:4] not in (b"II*\0", b"MM\0*"):
            raise ValueError(f"not a TIFF file: {path}")
        order = "<" if raw[:2] == b"II" else ">"
        f.seek(struct.unpack(order + "I", raw[4:])[0])
        tags = {}
        entries = f.read(12 * struct.unpack(order + "H", f.read(2))[0])
        for i in range(0, len(entries), 12):
            tag, kind, n = struct.unpack_from(order + "HHI", entries, i)
            if kind in _SIZES:
                code, size = _SIZES[kind]
                body = entries[i + 8 : i + 12]
                if n * size > 4:
                    f.seek(struct.unpack(order + "I", body)[0])
                    body = f.read(n * size)
                tags[tag] = body[:n].rstrip(b"\0").decode() if kind == 2 else list(struct.unpack(f"{order}{n}{code}", body[: n * size]))
    one = lambda tag, default: tags.get(tag, [default])[0]
    if one(BANDS, 1) != 1 or one(BITS, 1) != 32 or one(FORMAT, 1) != 3:
        raise ValueError("only one band of 32-bit floats is supported")
    if one(COMPRESSION, 1) not in _UNPACK or one(PREDICTOR, 1) not in (1, 2, 3):
        raise ValueError("only plain, deflate, LZW and packed-bits data are supported")
    if SCALE not in tags or len(tags.get(TIEPOINT, [])) != 6:
        raise ValueError("a pixel scale and a single tie point are needed")
    keys = {tags[KEYS][i]: tags[KEYS][i + 3] for i in range(4, len(tags.get(KEYS, [])), 4)}
    if keys.get(1024, 2) != 2 or keys.get(1025, 1) != 1:
        raise ValueError("only geographic coordinates with area pixels are supported")
    dx, dy = tags[SCALE][:2]
    if not (0 < dx < float("inf") and 0 < dy < float("inf")):
        raise ValueError("pixel sizes must be positive")
    i, j, _, x, y, _ = tags[TIEPOINT]
    width, height = tags[WIDTH][0], tags[HEIGHT][0]
    tiled = TILE_OFFSETS in tags
    shape = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if tiled else (width, min(height, one(ROWS, height)))
    nodata = float(tags[NODATA]) if tags.get(NODATA) else None
    return Grid(path, width, height, x - i * dx, y + j * dy, dx, dy, nodata, shape, tags[TILE_OFFSETS if tiled else OFFSETS], tags[TILE_COUNTS if tiled else COUNTS], one(COMPRESSION, 1), order, one(PREDICTOR, 1))


def read_tile(grid: Grid, number: int) -> np.ndarray:
    """The pixels of a tile, cut at the raster's edges."""
    with open(grid.path, "rb") as f:
        f.seek(grid.offsets[number])
        raw = f.read(grid.counts[number])
    raw = _UNPACK[grid.compression](raw)
    w, h = grid.tile
    ty, tx = divmod(number, grid.across)
    rows = len(raw) // 4 // w
    raw = raw[: rows * w * 4]
    if grid.predictor == 3:  # bytes of like weight lie together, and each is a difference to the one before
        planes = np.cumsum(np.frombuffer(raw, np.uint8).reshape(rows, 4 * w), axis=1, dtype=np.uint8)
        values = np.ascontiguousarray(planes.reshape(rows, 4, w).transpose(0, 2, 1)).view(">f4").reshape(rows, w)
    elif grid.predictor == 2:
        values = np.cumsum(np.frombuffer(raw, grid.order + "u4").reshape(rows, w), axis=1, dtype=np.uint32).view(np.float32)
    else:
        values = np.frombuffer(raw, grid.order + "f4").reshape(rows, w)
    return values[: min(h, grid.height - ty * h), : min(w, grid.width - tx * w)]


def tiles(spark: SparkSession, path: str) -> DataFrame:
    """(tx, ty, row0, col0, width, height, data): tiles read by the executors, one task for several tiles."""
    grid = read_grid(path)
    numbers = spark.range(len(grid.offsets))

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for n in batch.column(0).to_pylist():
                data = read_tile(grid, n).astype("<f4")
                ty, tx = divmod(n, grid.across)
                yield pa.RecordBatch.from_pylist([{"tx": tx, "ty": ty, "row0": ty * grid.tile[1], "col0": tx * grid.tile[0], "width": data.shape[1], "height": data.shape[0], "data": data.tobytes()}], pa.schema([(c, pa.int32()) for c in ("tx", "ty", "row0", "col0", "width", "height")] + [("data", pa.binary())]))

    return numbers.mapInArrow(run, "tx int, ty int, row0 int, col0 int, width int, height int, data binary")


def write_grid(path: str, values: np.ndarray, x0: float, y0: float, step: float, nodata: float | None = None, tile: int = 16, deflate: bool = True) -> None:
    """Writes a small tiled raster, for fixtures and exports."""
    height, width = values.shape
    across, down = -(-width // tile), -(-height // tile)
    parts = []
    for ty in range(down):
        for tx in range(across):
            block = np.zeros((tile, tile), "<f4")
            own = values[ty * tile : (ty + 1) * tile, tx * tile : (tx + 1) * tile]
            block[: own.shape[0], : own.shape[1]] = own
            parts.append(zlib.compress(block.tobytes()) if deflate else block.tobytes())
    at, offsets = 8, []
    for p in parts:
        offsets.append(at)
        at += len(p)
    text = (str(nodata) + "\0").encode() if nodata is not None else b""
    tags = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [32]), (COMPRESSION, 3, [8 if deflate else 1]), (BANDS, 3, [1]), (TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]), (TILE_OFFSETS, 4, offsets), (TILE_COUNTS, 4, [len(p) for p in parts]), (FORMAT, 3, [3]), (SCALE, 12, [step, step, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (KEYS, 3, [1, 1, 0, 2, 1024, 0, 1, 2, 1025, 0, 1, 1])]
    tags = sorted([*tags, *([(NODATA, 2, text)] if text else [])])
    start, extra, body = at + 2 + 12 * len(tags) + 4, b"", b""
    for tag, kind, value in tags:
        raw = value if kind == 2 else struct.pack(f"<{len(value)}{_SIZES[kind][0]}", *value)
        if len(raw) > 4:
            body += struct.pack("<HHII", tag, kind, len(value), start + len(extra))
            extra += raw
        else:
            body += struct.pack("<HHI", tag, kind, len(value)) + raw.ljust(4, b"\0")
    with open(path, "wb") as f:
        f.write(b"II*\0" + struct.pack("<I", at) + b"".join(parts) + struct.pack("<H", len(tags)) + body + struct.pack("<I", 0) + extra)
