"""Sums of a pixel grid over rectangles and polygons, and their roll-up along the hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_data(value: Column, nodata: float | None = None) -> Column:
    good = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return good if nodata is None else good & (value != F.lit(nodata).cast("float"))


def rectangle_sums(pixels: DataFrame, rectangles: DataFrame, cell: float = 1.0, nodata: float | None = None) -> DataFrame:
    """pixels: lon, lat (centres), v. rectangles: id, xmin, ymin, xmax, ymax. A pixel belongs where xmin <= lon < xmax and
    ymin <= lat < ymax; negative samples count as pixels and add nothing.

    Both sides meet on square cells of `cell` degrees, so the range condition is checked within a cell alone.
    """
    p = pixels.where(is_data(F.col("v"), nodata)).withColumns({"_x": F.floor(F.col("lon") / cell), "_y": F.floor(F.col("lat") / cell)})
    r = rectangles.withColumn("_x", F.explode(F.sequence(F.floor(F.col("xmin") / cell), F.floor(F.col("xmax") / cell))))
    r = r.withColumn("_y", F.explode(F.sequence(F.floor(F.col("ymin") / cell), F.floor(F.col("ymax") / cell))))
    inside = (F.col("lon") >= F.col("xmin")) & (F.col("lon") < F.col("xmax")) & (F.col("lat") >= F.col("ymin")) & (F.col("lat") < F.col("ymax"))
    return p.join(r, ["_x", "_y"]).where(inside).groupBy("id").agg(F.sum(F.greatest(F.col("v").cast("double"), F.lit(0.0))).alias("total"), F.count("*").alias("pixels"))


def roll_up(leaves: DataFrame, above: DataFrame) -> DataFrame:
    """leaves: id, total (null if it could not be measured), pixels. above: id, ancestor. Every leaf is rounded once;
    each ancestor gets the sum of its leaves, and `incomplete` if one of them has no total."""
    whole = leaves.select("id", F.round("total").cast("long").alias("quantity"), "pixels", F.col("total").isNull().alias("missing"))
    up = whole.join(above, "id").groupBy(F.col("ancestor").alias("id"))
    sums = up.agg(F.sum("quantity").alias("quantity"), F.sum("pixels").alias("pixels"), F.bool_or("missing").alias("incomplete"))
    return whole.select("id", "quantity", "pixels", F.col("missing").alias("incomplete")).unionByName(sums)


def polygon_sums(tiles: DataFrame, polygons: DataFrame, grid) -> DataFrame:
    """(id, total, pixels) of each polygon over the tiles of a raster (see sources.geotiff): pixels whose centre lies inside,
    by the scanline rule that gives a centre on a shared edge to one side.

    A polygon meets the tiles that its bounding box touches by an equi-join on the tile; each pair is summed by itself,
    so large polygons spread over as many tasks as they have tiles, and are rounded only after all are added.
    """
    import numpy as np
    import pyarrow as pa

    from ..functions import geometry as geo

    w, h = grid.tile[0] * grid.dx, grid.tile[1] * grid.dy
    box = polygons.select("id", F.col("geometry").alias("wkb"), "bbox")
    span = [F.floor((F.col("bbox.xmin") - grid.x0) / w), F.floor((F.col("bbox.xmax") - grid.x0) / w), F.floor((grid.y0 - F.col("bbox.ymax")) / h), F.floor((grid.y0 - F.col("bbox.ymin")) / h)]
    across, down = grid.across, -(-grid.height // grid.tile[1])
    low_x, high_x, low_y, high_y = F.greatest(span[0], F.lit(0)), F.least(span[1], F.lit(across - 1)), F.greatest(span[2], F.lit(0)), F.least(span[3], F.lit(down - 1))
    touched = box.withColumns({"_a": low_x, "_b": high_x, "_c": low_y, "_d": high_y}).where("_a <= _b and _c <= _d")
    touched = touched.withColumn("tx", F.explode(F.sequence("_a", "_b"))).withColumn("ty", F.explode(F.sequence("_c", "_d"))).select("id", "wkb", F.col("tx").cast("int"), F.col("ty").cast("int"))
    nodata = grid.nodata

    def run(batches):
        for batch in batches:
            out = []
            for key, wkb, row0, col0, width, height, data in zip(*(batch.column(c).to_pylist() for c in ("id", "wkb", "row0", "col0", "width", "height", "data")), strict=True):
                v = np.frombuffer(data, "<f4").reshape(height, width)
                good = np.isfinite(v) if nodata is None else np.isfinite(v) & (v != np.float32(nodata))
                parts = geo.from_wkb(wkb)
                e, total, pixels = geo.edges(parts), 0.0, 0
                for r in range(height):
                    lat = grid.y0 - (row0 + r + 0.5) * grid.dy
                    for a, b in geo.zonal_spans(e, lat, grid.x0 + col0 * grid.dx, grid.dx, width):
                        own = v[r, a : b + 1][good[r, a : b + 1]].astype(float)
                        total, pixels = total + float(np.maximum(own, 0).sum()), pixels + len(own)
                out.append((key, total, pixels))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 3, (pa.string(), pa.float64(), pa.int64()), strict=True)], names=["id", "total", "pixels"])

    met = tiles.join(touched, ["tx", "ty"]).select("id", "wkb", "row0", "col0", "width", "height", "data")
    return met.mapInArrow(run, "id string, total double, pixels long").groupBy("id").agg(F.sum("total").alias("total"), F.sum("pixels").alias("pixels"))


def grand_total(tiles: DataFrame, nodata: float | None) -> DataFrame:
    """One row: the sum and number of all data pixels."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            v = [np.frombuffer(d, "<f4") for d in batch.column(0).to_pylist()]
            good = [x[np.isfinite(x) if nodata is None else np.isfinite(x) & (x != np.float32(nodata))].astype(float) for x in v]
            yield pa.RecordBatch.from_arrays([pa.array([float(np.maximum(x, 0).sum()) for x in good], pa.float64()), pa.array([len(x) for x in good], pa.int64())], names=["total", "pixels"])

    return tiles.select("data").mapInArrow(run, "total double, pixels long").agg(F.sum("total").alias("total"), F.sum("pixels").alias("pixels"))


def assigned_share(sums: DataFrame, total: DataFrame) -> DataFrame:
    """One row: the percentage of a raster's total that the polygons' sums hold, with two decimals."""
    both = sums.agg(F.sum("total").alias("_sum")).crossJoin(total.select("total"))  # two single rows
    return both.select(F.round(100 * F.try_divide(F.coalesce("_sum", F.lit(0.0)), F.col("total")), 2).alias("assigned"))
