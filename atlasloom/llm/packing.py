"""Packing documents into sequences of fixed length: concatenate and cut.

First pass: tokens are written once to the workspace with, for each document, the partition it was read
in and the tokens before it there; the partitions' totals (one number each) are prefix-summed into global
offsets. Second pass: every document knows its place in the one concatenated stream, which is cut into
windows of `length`; where windows end, pieces end, and a sequence that documents of two partitions
share has a piece from each (`boundary`). No token is shuffled while the partitions' offsets, one row a partition, are
counted to be few enough for a broadcast (a million); sequences are gapless, and only the last can be short, so at most length - 1 places are
padding whatever the corpus.

Null and empty texts hold the end id alone. Repeated rows are documents of their own, a null id stays
null. Other columns are not read. An empty table gives no pieces. A document of any length is cut freely.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import beside, bounded, claim, materialize, slices, text_buffers, workspace
from .tokens import encoder

LENGTH, END_ID = 2048, 1


def texts_of(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) a slice at a time; null is empty."""
    _, offsets = text_buffers(column)
    for low, high in slices(offsets):
        yield low, [t or "" for t in column.slice(low, high - low).to_pylist()]


def tokenized(docs: DataFrame, tokenizer: str, style: str, end_id: int, id_col: str, text_col: str, path: str) -> DataFrame:
    """(doc, ids, n, part, before), written to path: ids little-endian, two bytes each for vocabularies below 65,536."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, total = encoder(tokenizer, style), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for low, texts in texts_of(batch.column(1)):
                ids = [x + end for x in enc.encode(texts)]
                n = np.array([len(x) // enc.dtype.itemsize for x in ids], np.int64)
                before = total + np.cumsum(n) - n
                total += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(texts)), pa.array(ids, pa.binary()), pa.array(n), pa.array(np.full(len(n), part, np.int32)), pa.array(before)],
                    names=["doc", "ids", "n", "part", "before"],
                )

    slim = bounded(docs).select(docs[id_col].cast("long").alias("doc"), docs[text_col].cast("string").alias("text"))
    return materialize(slim.mapInArrow(run, "doc long, ids binary, n long, part int, before long"), path)


def partition_offsets(tokens: DataFrame) -> DataFrame:
    """(part, base, held): tokens in all earlier partitions and in this, one row per partition of the scan."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", "held", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))


def pack(docs: DataFrame, tokenizer: str, style: str = "byte", length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, boundary and (with_ids) the ids."""
    path = workspace(docs.sparkSession)
    tokens = tokenized(docs, tokenizer, style, end_id, id_col, text_col, f"{path}/tokens")
    placed = beside(tokens, materialize(partition_offsets(tokens), f"{path}/offsets"), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("packing")
        for batch in batches:
            n = batch.column("n").to_numpy()
            base = batch.column("base").to_numpy()
            first = base + batch.column("before").to_numpy()
            last = first + n - 1
            pieces = last // length - first // length + 1
            row = np.repeat(np.arange(len(n)), pieces)
            window = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces) + (first // length)[row]
            low = np.maximum(window * length, first[row])
            high = np.minimum((window + 1) * length, last[row] + 1)
            start, size = low - first[row], high - low
            wide = [np.frombuffer(x, "<u2" if len(x) == 2 * k else "<u4").astype("<u4") for x, k in zip(batch.column("ids").to_pylist(), n.tolist(), strict=True)]
            ids = [wide[r][s : s + k].tobytes() for r, s, k in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)]
            end = base + batch.column("held").to_numpy()
            boundary = (window * length < base[row]) | ((window + 1) * length > end[row])
            columns = [batch.column("doc").take(pa.array(row)), pa.array(start), pa.array(size), pa.array(np.array([zlib.crc32(x) for x in ids], np.int64)), pa.array(n[row]), pa.array(window), pa.array(low - window * length), pa.array(boundary)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=names)

    kinds = [(id_col, "long"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"), ("boundary", "boolean"), ("ids", "binary")]
    kinds = kinds[: len(kinds) - (not with_ids)]
    names = [k for k, _ in kinds]
    return placed.select("doc", "ids", "n", "before", "base", "held").mapInArrow(run, ", ".join(f"`{k}` {v}" for k, v in kinds))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, used): each sequence's ids in order, little-endian unsigned 32-bit; a short one is
    padded to `length` unless its own length is a power of two. A group holds at most `length` ids."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, used = [], []
            for parts in batch.column(1).to_pylist():
                ids = b"".join(p["ids"] for p in parts)
                k = len(ids) // 4
                used.append(k)
                out.append(ids if k & (k - 1) == 0 else ids + np.full(length - k, pad_id, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(used, pa.int64())], names=["sequence_id", "ids", "used"])

    grouped = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return grouped.mapInArrow(whole, "sequence_id long, ids binary, used long")
