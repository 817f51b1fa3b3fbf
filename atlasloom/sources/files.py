"""File sources: document lines with their order, GeoJSON in three shapes, saved pages, CSV rows, and format sniffing."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_FORMATS = {".ndjson": "ndjson", ".jsonl": "ndjson", ".geojsonl": "geojson-lines", ".geojsons": "geojson-lines", ".geojson": "geojson", ".json": "geojson", ".parquet": "geoparquet", ".geoparquet": "geoparquet", ".csv": "csv"}


def format_of(path: str) -> str:
    """The input format that a path's extension names; .gz is looked through."""
    name = path.rstrip("/").removesuffix(".gz")
    for end, kind in LINE_FORMATS.items():
        if name.endswith(end):
            return kind
    raise ValueError(f"no known input format: {path}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(seq, text): non-blank lines, trimmed, without a byte order mark. seq orders lines as in their files.

    The order needs no extra job and no Python: a line's split start and its row id within the split ascend together.
    Pretty-printed or array JSON is refused. Gzip files are read as one split each.
    """
    raw = spark.read.text(path).select(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias("seq"), F.trim(F.regexp_replace("value", "^﻿", "")).alias("text"))
    lines = raw.where("text <> ''")
    first = lines.limit(1).collect()
    if first and (first[0]["text"] == "{" or first[0]["text"].startswith("[")):
        raise ValueError(f"{path} holds one pretty-printed or array document, not a document per line")
    return lines


def expand_bundles(lines: DataFrame) -> DataFrame:
    """(seq, text) with every Bundle line replaced by its entries' resources; others stay. Entries keep their raw order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, place, text = [], [], []
            for i, line in enumerate(batch.column("text").to_pylist()):
                try:
                    value = json.loads(line) if '"Bundle"' in line else None
                except ValueError:
                    value = None
                found = [line]
                if isinstance(value, dict) and value.get("resourceType") == "Bundle":
                    found = [json.dumps(e["resource"], ensure_ascii=False, separators=(",", ":")) for e in value.get("entry") or [] if isinstance(e, dict) and isinstance(e.get("resource"), dict)]
                at += [i] * len(found)
                place += range(len(found))
                text += found
            yield pa.RecordBatch.from_arrays([batch.column("seq").take(pa.array(at, pa.int64())), pa.array(place, pa.int32()), pa.array(text, pa.string())], names=["line", "place", "text"])

    kind = lines.schema["seq"].dataType.simpleString()
    return lines.mapInArrow(run, f"line {kind}, place int, text string").select(F.struct("line", "place").alias("seq"), "text")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(seq, properties, geometry as text, id): features of a FeatureCollection or of one Feature per line, decoded lazily from raw JSON."""

    def features(text: str) -> Iterator[dict]:
        value = json.loads(text)
        if isinstance(value, dict) and value.get("type") == "Feature":
            yield value
        elif isinstance(value, dict) and isinstance(value.get("features"), list):
            yield from (f for f in value["features"] if isinstance(f, dict))
        else:
            raise ValueError("neither a Feature nor a FeatureCollection")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                found = list(features(text))
                for low in range(0, len(found), 1024):
                    part = found[low : low + 1024]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("seq").take(pa.array([i] * len(part))), pa.array(range(low, low + len(part)), pa.int32()), pa.array([json.dumps(f.get("properties") or {}, ensure_ascii=False) for f in part]), pa.array([json.dumps(f["geometry"]) if f.get("geometry") else None for f in part], pa.string()), pa.array([None if f.get("id") is None else str(f["id"]) for f in part], pa.string())],
                        names=["file", "place", "properties", "geometry", "feature_id"],
                    )

    whole = format_of(path) == "geojson"
    lines = spark.read.text(path, wholetext=whole).select(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")).alias("seq"), F.trim("value").alias("text")).where("text <> ''")
    kind = lines.schema["seq"].dataType.simpleString()
    return lines.mapInArrow(run, f"file {kind}, place int, properties string, geometry string, feature_id string").select(F.struct("file", "place").alias("seq"), "properties", "geometry", "feature_id")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV rows with a header, every value a string."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return rows.toDF(*[c.removeprefix("﻿") for c in rows.columns])


def read_analytics(responses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(the columns to keep, dx, pe, ou, value, numerator, denominator, option), all strings, of wide responses `text` = {headers: [{name}], rows: [[...]]}.

    Cells are found by their header's name; a response without dx, pe, ou or value fails, a missing cell is empty.
    """
    shape = "struct<headers:array<struct<name:string>>,rows:array<array<string>>>"
    keep = keep or []
    rows = responses.select(*keep, F.from_json("text", shape).alias("r")).select(*keep, F.col("r.headers.name").alias("names"), F.explode("r.rows").alias("row"))

    def cell(name: str, needed: bool):
        at = F.array_position("names", name)
        found = F.coalesce(F.get("row", (at - 1).cast("int")), F.lit(""))
        return F.when(at > 0, found).otherwise(F.raise_error(F.lit(f"no column {name}")).cast("string") if needed else F.lit("")).alias(name)

    fixed = [cell(c, c in ("dx", "ou", "value") or (c == "pe" and not keep)) for c in ("dx", "pe", "ou", "value", "numerator", "denominator")]
    known = F.array(*map(F.lit, ("dx", "pe", "ou", "value", "numerator", "denominator", "factor", "multiplier", "divisor")))
    extra = F.get(F.filter("names", lambda n: ~F.array_contains(known, n)), F.lit(0))
    option = F.when(extra.isNotNull(), F.get("row", (F.array_position("names", extra) - 1).cast("int")))
    return rows.select(*keep, *fixed, F.coalesce(option, F.lit("")).alias("option"))
