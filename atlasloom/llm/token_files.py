"""Token-id files: canonical length-limited Huffman codes from global counts, read back through a table.

A file set is a folder of two Parquet tables, so any store that Spark reads can hold it:

* `codebook` (id, length): the code lengths; the canonical codes follow from them (shorter first, then by id).
* `blocks`, one row per independent block of whole documents: part and block number (ascending documents),
  `first` (tokens of the part before the block), doc ids, token counts, `payload` (codes most significant
  bit first in big-endian 32-bit words), `checkpoints` (the bit offset of every 512th token, from which
  decoding can start) and the payload's crc32.

Tokenizing runs once, into a table of the workspace that also holds each task's histogram; the counts are
summed in the cluster and only one row per used id, at most the vocabulary, reaches the driver. Documents
are dealt by ranges of their id and of the place where they were read, and sorted within, so ascending parts hold
ascending documents, and rows that share an id, however many, spread over ranges in the order they were read in.

Null and empty texts hold the end id alone; null ids come first; repeated rows stay; an empty table gives
empty files. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import beside, bounded, claim, materialize, workspace
from .packing import END_ID, texts_of
from .tokens import encoder

LIMIT, STRIDE, BLOCK = 18, 512, 1 << 16
_TOKENS = "doc long, part int, row long, packed binary, width int, hist array<struct<id:int,n:long>>"
_BLOCKS = "part int, block int, first long, docs array<long>, counts array<long>, payload binary, checkpoints array<long>, crc long"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code without any over `limit` (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, flags = leaves, []
    for _ in range(limit):
        flags.append(None if level is leaves else own)
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        rank = np.argsort(both, kind="stable")
        own, level = rank < len(leaves), both[rank]
    take, found = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for own in reversed(flags):
        mine = take if own is None else int(own[:take].sum())
        found[:mine] += 1
        take = 2 * (take - mine)
    lengths[order] = found
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id, shorter codes first and equal lengths by id."""
    codes = np.zeros(len(lengths), np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]
    code = before = 0
    step = lengths[used].astype(np.int64)
    for length in np.unique(step).tolist():
        own = used[step == length]
        code <<= length - before
        codes[own] = code + np.arange(len(own))
        code, before = code + len(own), length
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(payload, checkpoints)."""
    size = lengths[ids].astype(np.int64)
    end = np.cumsum(size)
    at = end - size
    word, value = at >> 5, codes[ids].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
    n = int((end[-1] + 31) >> 5) + 1
    words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n)[:n]
    return words.astype(np.uint32).astype(">u4").tobytes(), at[::STRIDE]


class Table:
    """All codes of `width` bits: the id that begins there and its length."""

    def __init__(self, lengths: np.ndarray):
        self.width = max(1, int(lengths.max(initial=0)))
        codes, used = canonical(lengths).astype(np.int64), np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        spread = 1 << (self.width - lengths[used].astype(np.int64))
        self.ids = np.zeros(1 << self.width, np.uint32)
        self.sizes = np.ones(1 << self.width, np.uint8)
        first = codes[used] * spread
        at = np.repeat(first - (np.cumsum(spread) - spread), spread) + np.arange(spread.sum())
        self.ids[at], self.sizes[at] = np.repeat(used, spread), np.repeat(lengths[used], spread)

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All segments between checkpoints advance together, a token of each at a time."""
        words = np.frombuffer(payload, ">u4").astype(np.uint64)
        words = np.concatenate([words, np.zeros(STRIDE * self.width // 32 + 2, np.uint64)])
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        at, mask = checkpoints.astype(np.int64), np.uint64((1 << self.width) - 1)
        out = np.empty((STRIDE, len(at)), np.uint32)
        for k in range(min(STRIDE, n)):
            code = ((pairs[at >> 5] >> (64 - self.width - (at & 31)).astype(np.uint64)) & mask).astype(np.int64)
            out[k] = self.ids[code]
            at = at + self.sizes[code]
        return out.T.reshape(-1)[:n]


def _tokens(docs: DataFrame, tokenizer: str, style: str, end_id: int, id_col: str, text_col: str, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pack = encoder(tokenizer, style), zstandard.ZstdCompressor(1).compress
        part, rows = TaskContext.get().partitionId(), 0
        end, seen = np.array([end_id], enc.dtype).tobytes(), np.zeros(max(enc.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        kind = pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))
        names = ["doc", "part", "row", "packed", "width", "hist"]
        for batch in batches:
            for low, texts in texts_of(batch.column(1)):
                ids = [x + end for x in enc.encode(texts)]
                seen += np.bincount(np.frombuffer(b"".join(ids), enc.dtype), minlength=len(seen))
                k = len(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, k), pa.array(np.full(k, part, np.int32)), pa.array(np.arange(rows, rows + k)), pa.array([pack(x) for x in ids], pa.binary()), pa.array([enc.dtype.itemsize] * k, pa.int32()), pa.nulls(k, kind)], names=names)
                rows += k
        used = np.flatnonzero(seen)
        hist = pa.array([[{"id": i, "n": n} for i, n in zip(used.tolist(), seen[used].tolist(), strict=True)]], kind)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), hist], names=names)

    slim = bounded(docs).select(docs[id_col].cast("long").alias("doc"), docs[text_col].cast("string").alias("text"))
    return materialize(slim.mapInArrow(run, _TOKENS), path)


def write_files(docs: DataFrame, folder: str, tokenizer: str, style: str = "word", end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the codebook and the blocks of all documents below folder, in ascending order of their ids."""
    spark = docs.sparkSession
    tokens = _tokens(docs, tokenizer, style, end_id, id_col, text_col, f"{workspace(spark)}/tokens")
    counted = tokens.where("hist is not null").select(F.explode("hist").alias("h")).groupBy("h.id").agg(F.sum("h.n").alias("n")).collect()
    counts = np.zeros(1 + max([end_id, *(r["id"] for r in counted)]), np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts)
    codes = canonical(lengths)
    spark.createDataFrame([(i, int(lengths[i])) for i in np.flatnonzero(lengths).tolist()], "id int, length int").coalesce(1).write.parquet(f"{folder}/codebook")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("files")
        part, unpack = TaskContext.get().partitionId(), zstandard.ZstdDecompressor().decompress
        block = first = held = 0
        docs: list = []
        parts: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            payload, marks = encode_block(np.concatenate(parts), lengths, codes)
            row = {"part": part, "block": block, "first": first, "docs": docs, "counts": [len(p) for p in parts], "payload": payload, "checkpoints": marks.tolist(), "crc": zlib.crc32(payload)}
            return pa.RecordBatch.from_pylist([row], schema=layout)

        layout = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("docs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("payload", pa.binary()), ("checkpoints", pa.list_(pa.int64())), ("crc", pa.int64())])
        for batch in batches:
            for doc, packed, width in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs.append(doc)
                parts.append(np.frombuffer(unpack(packed), f"<u{width}"))
                held += len(parts[-1])
                if held >= BLOCK:
                    yield flush()
                    block, first, held, docs, parts = block + 1, first + held, 0, [], []
        if docs:
            yield flush()

    ordered = tokens.where("hist is null").drop("hist").repartitionByRange("doc", "part", "row").sortWithinPartitions("doc", "part", "row")
    ordered.select("doc", "packed", "width").mapInArrow(run, _BLOCKS).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_files(spark: SparkSession, folder: str, with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, start (ids of all documents before it), n_tokens, ids_crc32 and (with_ids) the ids, little-endian unsigned 32-bit."""
    book = spark.read.schema("id int, length int").parquet(f"{folder}/codebook").collect()
    lengths = np.zeros(1 + max([0, *(r["id"] for r in book)]), np.uint8)
    for r in book:
        lengths[r["id"]] = r["length"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    totals = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(totals.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base")), f"{workspace(spark)}/bases")  # one row per file part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("files")
        decode = Table(lengths).decode
        for batch in batches:
            for row in batch.to_pylist():
                if zlib.crc32(row["payload"]) != row["crc"]:
                    raise ValueError(f"block {row['block']} of part {row['part']} is damaged")
                counts = np.array(row["counts"], np.int64)
                end = np.cumsum(counts)
                ids = decode(row["payload"], np.array(row["checkpoints"], np.int64), int(end[-1])).astype("<u4")
                raw = [ids[a:b].tobytes() for a, b in zip((end - counts).tolist(), end.tolist(), strict=True)]
                columns = [pa.array(row["docs"], pa.int64()), pa.array(row["base"] + row["first"] + end - counts), pa.array(counts), pa.array([zlib.crc32(x) for x in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(raw, pa.binary())] * with_ids, names=[id_col, "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    return bounded(beside(blocks, bases, "part")).mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
