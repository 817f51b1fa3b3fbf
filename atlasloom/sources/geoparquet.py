"""GeoParquet: partitioned writer with bounding-box footers, reader, and inspection of footers.

A partition is a folder `key=value/...` whose columns are also stored in the file. Tasks write their stretch of the curve in
order to files of their own attempt in a staging folder; only files named in the manifest that the job returns
are moved to their places, so failed and repeated attempts leave nothing behind.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.scalars import path_segment

KEYS, ROWS_IN_GROUP = ("country", "geom_type", "type"), 20_000
#: Rows, and bytes of geometry and documents before compression, that a file holds at most (about), and rows for which another core is put to work.
ROWS_IN_FILE, BYTES_IN_FILE, ROWS_FOR_CORE = 400_000, 256 << 20, 20_000


def geo_footer(box: list[float] | None, kinds: list[str]) -> bytes:
    column = {"encoding": "WKB", "geometry_types": kinds, "covering": {"bbox": {c: ["bbox", c] for c in ("xmin", "ymin", "xmax", "ymax")}}}
    return json.dumps({"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": column | ({"bbox": box} if box else {})}}).encode()


def place_folders(values: list[tuple], keys: list[str]) -> tuple[dict[tuple, str], list[dict]]:
    """(folder of each tuple of (value, segment) pairs, issues): of values that give one folder name, later ones get a suffix of their hash."""
    taken: dict[tuple[str, str], str] = {}
    folders, issues = {}, []
    for row in values:
        path = ""
        for key, (value, segment) in zip(keys, row, strict=True):
            shown, salt, name = "null" if value is None else value, 0, segment
            if segment != shown:
                issues.append({"kind": "partition_value_sanitized", "location_id": shown, "detail": f"{key}={segment}"})
            while taken.setdefault((path, f"{key}={name}".lower()), shown) != shown:
                name = f"{segment}~{hashlib.sha256(f'{segment}\0{shown}{salt or ""}'.encode()).hexdigest()[:8]}"
                issues.append({"kind": "partition_value_collision", "location_id": shown, "detail": f"{key}={name}"})
                salt += 1
            path = f"{path}/{key}={name}".lstrip("/")
        folders[row] = path
    return folders, issues


def write(rows: DataFrame, out: str, keys: tuple[str, ...] = KEYS, rows_in_group: int = ROWS_IN_GROUP, order: str = "hilbert", tie: str = "id") -> list[dict]:
    """Writes rows (a written table) below out, a folder that driver and executors share, replacing what is there; returns the manifest.

    Rows are dealt by ranges of (partition, curve key, id): a task holds a stretch of the curve, so that a file's box
    is small, and no partition is too large for its files. A file ends where a stretch or its partition does.
    The number of distinct partition values is what the layout can hold as folders; they alone reach the driver.
    """
    staging, final = f"{out.rstrip('/')}.staging-{uuid.uuid4().hex}", out.rstrip("/")
    shown = rows.withColumns({f"_k{i}": F.coalesce(F.col(k).cast("string"), F.lit("null")) for i, k in enumerate(keys)})
    names = [f"_k{i}" for i in range(len(keys))]
    size = F.sum(F.coalesce(F.length("geometry"), F.lit(0)) + F.coalesce(F.length("fhir_json"), F.lit(0))) if "fhir_json" in rows.columns else F.sum(F.coalesce(F.length("geometry"), F.lit(0)))
    counts = shown.groupBy(*names).agg(F.count("*").alias("_n"), size.alias("_bytes")).withColumns({f"_s{i}": path_segment(F.col(n)) for i, n in enumerate(names)})
    listed = counts.orderBy(*names).collect()
    folders, issues = place_folders([tuple((r[n], r[f"_s{i}"]) for i, n in enumerate(names)) for r in listed], list(keys))
    total = sum(r["_n"] for r in listed)
    files = max(1, -(-total // ROWS_IN_FILE), -(-sum(r["_bytes"] for r in listed) // BYTES_IN_FILE), min(total // ROWS_FOR_CORE, rows.sparkSession.sparkContext.defaultParallelism))
    by = [*names, F.col(order).asc_nulls_last(), tie]
    dealt = (shown.repartitionByRange(files, *by) if files > 1 else shown.coalesce(1)).sortWithinPartitions(*by)
    layout = [f for f in to_arrow_schema(rows.schema)]
    place = {tuple(v for v, _ in k): v for k, v in folders.items()}
    kinds = {1: "Point", 3: "Polygon", 6: "MultiPolygon"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, done, writer, now, state = TaskContext.get(), [], None, None, {}
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"

        def close() -> None:
            if writer:
                flush(0)
                writer.add_key_value_metadata({"geo": geo_footer(state["box"], sorted(state["kinds"])).decode()})
                writer.close()
                done.append({"staged": state["path"], "folder": place[now], "file": context.partitionId(), "rows": state["rows"]})

        def flush(least: int) -> None:
            """Whole row groups of what is held; the rest too if least is 0."""
            while state["held"] and (sum(t.num_rows for t in state["held"]) >= rows_in_group or not least):
                table = pa.concat_tables(state["held"])
                writer.write_table(table.slice(0, rows_in_group), row_group_size=rows_in_group)
                state["held"] = [table.slice(rows_in_group)] if table.num_rows > rows_in_group else []

        for batch in batches:
            table = pa.Table.from_batches([batch])
            marks = list(zip(*(table.column(c).to_pylist() for c in names), strict=True))
            low = 0
            while low < len(marks):
                high = low
                while high < len(marks) and marks[high] == marks[low]:
                    high += 1
                if marks[low] != now:
                    close()
                    now = marks[low]
                    state = {"path": f"{staging}/{attempt}-{len(done)}.parquet", "rows": 0, "box": None, "kinds": set(), "held": []}
                    os.makedirs(staging, exist_ok=True)
                    writer = pq.ParquetWriter(state["path"], pa.schema(layout), compression="zstd", compression_level=3)
                part = table.slice(low, high - low).select([f.name for f in layout]).cast(pa.schema(layout))
                state["held"].append(part)
                state["rows"] += high - low
                shaped = part.filter(pc.and_(pc.is_valid(part.column("geometry")), pc.is_valid(part.column("bbox"))))
                if shaped.num_rows:
                    edges = [pc.struct_field(shaped.column("bbox"), c) for c in ("xmin", "ymin", "xmax", "ymax")]
                    own = [f(e).as_py() for f, e in zip((pc.min, pc.min, pc.max, pc.max), edges, strict=True)]
                    b = state["box"]
                    state["box"] = own if b is None else [min(b[0], own[0]), min(b[1], own[1]), max(b[2], own[2]), max(b[3], own[3])]
                    state["kinds"].update(kinds[x[0]] for x in pc.unique(pc.binary_slice(shaped.column("geometry"), 1, 2)).to_pylist())
                flush(rows_in_group)
                low = high
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, pa.schema([("staged", pa.string()), ("folder", pa.string()), ("file", pa.int32()), ("rows", pa.int64())]))

    manifest = sorted((r.asDict() for r in dealt.mapInArrow(run, "staged string, folder string, file int, rows long").collect()), key=lambda m: (m["folder"], m["file"]))
    ready, nth = f"{final}.new-{uuid.uuid4().hex}", {}
    os.makedirs(ready)
    for m in manifest:
        m["file"] = nth[m["folder"]] = nth.get(m["folder"], -1) + 1
        os.makedirs(f"{ready}/{m['folder']}", exist_ok=True)
        os.replace(m["staged"], f"{ready}/{m['folder']}/part-{m['file']}.parquet")
    shutil.rmtree(staging, ignore_errors=True)
    swap_in(ready, final)
    small = [{"kind": "small_partition", "location_id": "/".join(r[n] for n in names), "detail": str(r["_n"])} for r in listed if r["_n"] < 100]
    return [*manifest, {"issues": issues + small}]


def swap_in(ready: str, final: str) -> None:
    """Puts a finished folder in place of an older one; an interrupted swap leaves the old one beside it under .backup."""
    if os.path.islink(final):
        raise ValueError(f"{final} is a link")
    backup = f"{final}.backup"
    if os.path.exists(backup) and not os.path.exists(final):
        os.rename(backup, final)
    shutil.rmtree(backup, ignore_errors=True)
    if os.path.exists(final):
        os.rename(final, backup)
    os.rename(ready, final)
    shutil.rmtree(backup, ignore_errors=True)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All files of a dataset with geometry as binary, whatever geometry type their footers declare."""
    first = next(iter(files(path)))
    schema = pq.ParquetFile(first).schema_arrow
    fields = [f.with_type(f.type.storage_type) if isinstance(f.type, pa.ExtensionType) else f for f in schema]
    from pyspark.sql.pandas.types import from_arrow_schema

    return spark.read.schema(from_arrow_schema(pa.schema(fields))).option("recursiveFileLookup", True).parquet(path)


def files(path: str) -> list[str]:
    """Parquet files below a path, links skipped, ordered by the components of their paths."""
    if os.path.isfile(path):
        return [path]
    found = [os.path.join(d, n) for d, _, names in os.walk(path, followlinks=False) for n in names if n.endswith(".parquet") and not os.path.islink(os.path.join(d, n))]
    return sorted(found, key=lambda p: p.split(os.sep))


def inspect(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, row_groups, bytes, least, mean, most, box): one row per file, from footers alone, read by the executors."""
    paths = spark.createDataFrame([(p,) for p in files(path)], "file string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p in batch.column(0).to_pylist():
                meta = pq.read_metadata(p)
                sizes = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
                own = json.loads((meta.metadata or {}).get(b"geo", b"{}"))
                box = own.get("columns", {}).get(own.get("primary_column", ""), {}).get("bbox")
                mean = int(sum(sizes) / len(sizes) + 0.5) if sizes else 0
                out.append({"file": p, "rows": meta.num_rows, "row_groups": len(sizes), "bytes": os.path.getsize(p), "least": min(sizes, default=0), "mean": mean, "most": max(sizes, default=0), "box": box})
            layout = pa.schema([("file", pa.string()), *[(c, pa.int64()) for c in ("rows", "row_groups", "bytes", "least", "mean", "most")], ("box", pa.list_(pa.float64()))])
            yield pa.RecordBatch.from_pylist(out, layout)

    return paths.mapInArrow(run, "file string, rows long, row_groups long, bytes long, least long, mean long, most long, box array<double>")
