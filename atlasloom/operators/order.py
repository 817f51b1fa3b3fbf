"""Numbers from 0 in a given order, and text files in that order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import folder, written

_BITS = 33  # of monotonically_increasing_id for the row within its partition


def numbered(rows: DataFrame, by: list[str], name: str = "place") -> DataFrame:
    """rows (a written table of them) with their number from 0 in the order of the columns `by`, which should tell all rows apart.

    Rows are dealt by ranges and sorted within; a row's number is its place in its range after the totals of the
    ranges before, one row each.
    """
    path = folder(rows.sparkSession)
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    dealt = written(dealt, f"{path}/dealt").withColumns({"_part": F.shiftright("_at", _BITS), "_row": F.col("_at").bitwiseAND(F.lit((1 << _BITS) - 1))})
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select(F.col("_part").alias("_p"), before.alias("_start"))
    return dealt.join(starts, F.col("_part") == F.col("_p")).withColumn(name, F.col("_start") + F.col("_row")).drop("_at", "_part", "_row", "_p", "_start")


def write_text(rows: DataFrame, out: str, by: list[str], column: str = "text") -> int:
    """The column as lines in order; returns their number.

    Executors write sorted part files below `out` if that ends in a slash. Otherwise the parts, which are already
    encoded (and compressed, for a name in .gz, as members that follow one another), are joined into one file that takes its name
    when it is whole.
    """
    spark = rows.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    many, packed = out.endswith("/"), out.endswith(".gz")
    parts = out.rstrip("/") if many else folder(spark)
    ordered = written(rows.select(column, *[F.col(c).alias(f"_o{k}") for k, c in enumerate(by)]), folder(spark)).orderBy(*[f"_o{k}" for k in range(len(by))])
    ordered.select(F.col(column).alias("value")).write.mode("overwrite").option("compression", "gzip" if packed else "none").text(parts)
    n = spark.read.text(parts).count()
    if many:
        return n
    at, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(out)
    source, sink = at.getFileSystem(conf), target.getFileSystem(conf)
    sink.setWriteChecksum(False)
    part = jvm.org.apache.hadoop.fs.Path(f"{out}.part")
    stream = sink.create(part, True)
    names = sorted(s.getPath().getName() for s in source.listStatus(at))
    for name in names:
        if name.startswith("part-"):
            piece = source.open(jvm.org.apache.hadoop.fs.Path(f"{parts}/{name}"))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(piece, stream, 1 << 20, False)
            piece.close()
    stream.close()
    if sink.exists(target):
        sink.delete(target, False)
    if not sink.rename(part, target):
        raise OSError(f"cannot put {out} in place")
    return n
