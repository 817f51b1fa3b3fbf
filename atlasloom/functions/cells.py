"""Spatial cells and curve keys as column expressions (no Python in the plan), and the curve key of places that are in Python anyway."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

MERCATOR_LIMIT = 85.05112878  # fixed value: the latitude where square Web Mercator ends
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"  # fixed value: the geohash alphabet


def _grid(value: Column, low: float, span: float, bits: int) -> Column:
    """The cell of 2**bits that holds a value, as a long, kept within the grid."""
    cell = F.floor((value - low) / F.lit(span) * F.lit(float(1 << bits))).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(F.lit((1 << bits) - 1).cast("long"), cell))


def hilbert_key(lon: Column, lat: Column, order: int = 16) -> Column:
    """Place on the Hilbert curve over the whole world; NaN and null count as the grid's origin."""
    most = (1 << order) - 1

    def axis(value: Column, low: float, span: float) -> Column:
        scaled = F.round((value - low) / F.lit(span) * F.lit(float(most))).cast("long")
        inside = F.greatest(F.lit(0).cast("long"), F.least(F.lit(most).cast("long"), scaled))
        return F.when(value.isNull() | F.isnan(value), F.lit(0).cast("long")).otherwise(inside)

    start = F.struct(axis(lon, -180.0, 360.0).alias("x"), axis(lat, -90.0, 180.0).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(state: Column, bit: Column) -> Column:
        side = F.pow(F.lit(2.0), bit).cast("long")
        x, y, d = state["x"], state["y"], state["d"]
        rx = F.when(x.bitwiseAND(side) > 0, 1).otherwise(0).cast("long")
        ry = F.when(y.bitwiseAND(side) > 0, 1).otherwise(0).cast("long")
        gained = d + side * side * ((3 * rx).bitwiseXOR(ry))
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, F.lit(most).cast("long") - x).otherwise(x), F.when(flip, F.lit(most).cast("long") - y).otherwise(y)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), gained.alias("d"))

    return F.aggregate(F.sequence(F.lit(order - 1), F.lit(0), F.lit(-1)), start, step, lambda state: state["d"])


def hilbert_keys(lon: list[float | None], lat: list[float | None], order: int = 16) -> np.ndarray:
    """hilbert_key of many places at once in numpy, for what is in Python anyway; None counts as the origin."""
    most = (1 << order) - 1

    def axis(values: list[float | None], low: float, span: float) -> np.ndarray:
        v = np.array([np.nan if x is None else x for x in values], float)
        scaled = np.floor((v - low) / span * most + 0.5)
        return np.where(np.isnan(v), 0, np.clip(np.nan_to_num(scaled), 0, most)).astype(np.int64)

    x, y = axis(lon, -180.0, 360.0), axis(lat, -90.0, 180.0)
    found = np.zeros(len(x), np.int64)
    for bit in range(order - 1, -1, -1):
        right, up = (x >> bit) & 1, (y >> bit) & 1
        found += ((3 * right) ^ up) << (2 * bit)
        turned, mirrored = up == 0, (up == 0) & (right == 1)
        x, y = np.where(mirrored, most - x, x), np.where(mirrored, most - y, y)
        x, y = np.where(turned, y, x), np.where(turned, x, y)
    return found


def tile(lon: Column, lat: Column, level: int) -> tuple[Column, Column]:
    """(x, y) of the Web Mercator tile at a level."""
    n = float(1 << level)
    kept = F.greatest(F.lit(-MERCATOR_LIMIT), F.least(F.lit(MERCATOR_LIMIT), lat))
    wrapped = (lon + 180.0) / 360.0
    wrapped = wrapped - F.floor(wrapped)
    sine = F.sin(kept * F.lit(math.pi) / 180.0)
    y = 0.5 - F.ln((1.0 + sine) / (1.0 - sine)) / F.lit(4.0 * math.pi)

    def cell(v: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(F.lit((1 << level) - 1).cast("long"), F.floor(v * n).cast("long")))

    return cell(wrapped), cell(y)


def quadkey(lon: Column, lat: Column, level: int) -> Column:
    """The quadkey of a point at level 1 to 23."""
    if not 1 <= level <= 23:
        raise ValueError("quadkey levels are 1 to 23")
    x, y = tile(lon, lat, level)
    digits = [((F.shiftright(x, b).bitwiseAND(F.lit(1))) + 2 * F.shiftright(y, b).bitwiseAND(F.lit(1))).cast("string") for b in range(level - 1, -1, -1)]
    return F.concat(*digits)


def geohash(lon: Column, lat: Column, length: int) -> Column:
    """The geohash of a point, 1 to 12 characters."""
    if not 1 <= length <= 12:
        raise ValueError("geohash lengths are 1 to 12")
    bits = 5 * length
    x, y = _grid(lon, -180.0, 360.0, (bits + 1) // 2), _grid(lat, -90.0, 180.0, bits // 2)

    def bit(k: int) -> Column:
        """Bit k from the left: longitude and latitude take turns."""
        own, width = (x, (bits + 1) // 2) if k % 2 == 0 else (y, bits // 2)
        return F.shiftright(own, width - 1 - k // 2).bitwiseAND(F.lit(1))

    letters = []
    for c in range(length):
        value = sum((bit(5 * c + k) * (16 >> k) for k in range(1, 5)), bit(5 * c) * 16)
        letters.append(F.substring(F.lit(BASE32), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*letters)


def parse_cell_argument(text: str) -> tuple[str, int]:
    """SCHEME:LEVEL as (scheme, level); h3 cells are carried but never computed."""
    scheme, _, level = text.partition(":")
    limits = {"quadkey": 23, "geohash": 12}
    if scheme == "h3":
        raise ValueError("h3 cells cannot be computed")
    if scheme not in limits or not level.isdigit() or not 1 <= int(level) <= limits[scheme]:
        raise ValueError(f"not a cell scheme and level: {text}")
    return scheme, int(level)


def deepest(cells: Column, scheme: str) -> Column:
    """Of an array of (scheme, level, cell) the deepest cell of a scheme; the last one on ties."""
    indexed = F.transform(F.filter(cells, lambda c: c["scheme"] == scheme), lambda c, i: F.struct(c["level"].alias("level"), i.alias("i"), c["cell"].alias("cell")))
    return F.try_element_at(F.array_sort(indexed), F.lit(-1))
