"""Line deduplication across documents.

Lines are exploded and normalised (ASCII white space stripped at both ends, A-Z lower-cased), keys of
enough code points are hashed to 128 bits, documents are counted per hash, and the lines of keys over the
threshold go from every document but the largest id that holds the key; the rest is joined in its order.

Two shuffles of 24-byte records, and one of those of frequent keys, by key and id (the count combines on the map side, so a key that a third of the rows
hold reaches one task as one record per map task; the join back to the holders is a plain sort-merge join
that adaptive execution splits), and one of the documents by id, to give each its keys to drop.

A document is an id: rows that repeat one count once, and all rows with the largest id keep the line. A row
with a null id is a document of its own, counts towards the threshold and keeps its lines. Null and empty texts hold one empty line.
Long keys are hashed whole. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, claim, free_name, materialize, workspace

MIN_CHARS, MIN_DOCUMENTS = 40, 5
_BLANK = b" \t\n\v\f\r"


def _keys(text: bytes, least: int) -> list[bytes | None]:
    """For each line of a text the hash of its key, or None where the key is too short to count."""
    out: list[bytes | None] = []
    digest = xxhash.xxh3_128_digest
    for line in text.lower().split(b"\n"):  # bytes.lower() changes A-Z alone
        key = line.strip(_BLANK)
        long = len(key) >= least and (key.isascii() or len(key.decode()) >= least)
        out.append(digest(key) if long else None)
    return out


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def line_keys(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(key, doc): the distinct keys of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lines")
        for batch in batches:
            ids, keys, held = batch.column(0), [], []
            for i, text in enumerate(_bytes(batch.column(1))):
                own = set(_keys(text, least)) - {None}
                keys += own
                held += [i] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), ids.take(pa.array(held, pa.int64()))], names=["key", "doc"])

    kind = docs.schema[id_col].dataType
    return bounded(docs).select(docs[id_col], docs[text_col].cast("string")).mapInArrow(run, T.StructType().add("key", "binary").add("doc", kind))


def dropped_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_documents: int) -> DataFrame:
    """(doc, drops): the keys whose lines each document loses; documents that lose none have no row."""
    path = workspace(docs.sparkSession)
    keys = materialize(line_keys(docs, id_col, text_col, min_chars), f"{path}/keys")
    often = keys.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("last")).where(F.col("n") >= min_documents).drop("n")
    often = materialize(often, f"{path}/often")  # apart from the join, whose hot keys can then be split, or which needs no shuffle at all
    # rows are at least as many as documents: only the keys that enough rows hold are counted by document
    held = materialize(keys.join(often, "key").groupBy("key", "doc", "last").agg(F.count("*").alias("c")), f"{path}/held")
    documents = F.sum(F.when(F.col("doc").isNull(), F.col("c")).otherwise(1))
    often = materialize(held.groupBy("key").agg(documents.alias("n")).where(F.col("n") >= min_documents).select("key"), f"{path}/documents")
    return held.join(often, "key").where("doc < last").groupBy("doc").agg(F.collect_set("key").alias("drops"))


def _kept(text: bytes, drops: list[bytes] | None, least: int) -> tuple[int, int, bytes]:
    lines = text.split(b"\n")
    if not drops:
        return len(lines), 0, text
    gone = set(drops)
    kept = [line for line, key in zip(lines, _keys(text, least), strict=True) if key not in gone]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _joined(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_documents: int) -> DataFrame:
    """docs with a last column of the keys to drop; `docs` keeps its own columns in their order."""
    doc, drops = free_name(docs, "_doc"), free_name(docs, "_drops")
    own = dropped_keys(docs, id_col, text_col, min_chars, min_documents).select(F.col("doc").alias(doc), F.col("drops").alias(drops))
    return docs.join(own, docs[id_col] == own[doc], "left").drop(doc)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents with their columns; texts without the dropped lines, and n_chars (if there) counted anew."""
    schema, at = docs.schema, docs.columns.index(text_col)
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lines")
        for batch in batches:
            columns, drops = list(batch.columns[:-1]), batch.columns[-1].to_pylist()
            if any(drops):
                texts = columns[at].cast(pa.binary()).to_pylist()
                texts = [None if t is None else _kept(t, d, min_chars)[2].decode() for t, d in zip(texts, drops, strict=True)]
                columns[at] = pa.array(texts, pa.string())
                if chars is not None:
                    old = columns[chars]
                    columns[chars] = pa.array([len(t) if d and t is not None else o for t, d, o in zip(texts, drops, old.to_pylist(), strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return _joined(docs, id_col, text_col, min_chars, min_documents).mapInArrow(run, schema)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per document: id, n_lines, n_dropped, kept_sha256 (of the kept text in UTF-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("lines")
        for batch in batches:
            got = [_kept(t, d, min_chars) for t, d in zip(_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())],
                names=[id_col, "n_lines", "n_dropped", "kept_sha256"],
            )

    slim = docs.select(docs[id_col], docs[text_col].cast("string").alias(text_col))
    schema = T.StructType().add(id_col, docs.schema[id_col].dataType).add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    return _joined(slim, id_col, text_col, min_chars, min_documents).mapInArrow(run, schema)
