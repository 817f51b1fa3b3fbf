"""SentencePiece encoding and decoding with a unigram reading of a piece model.

Words are encoded by a batched Viterbi in numpy: words of equal length advance together, a code point at a
time; the 64-bit hash of every substring up to the longest piece probes the sorted keys of the pieces, and
the best score of each position with the length of its last piece (the longest on ties) is kept. Words of a length
that few share (among them long ones, such as encoded data without spaces) probe together, all positions of SPAN code points at a
time, and their matches alone then advance one by one: linear in the length, with the same sums in the same order. Scores
are summed in double precision, word by word, so long texts lose nothing.

The text is the library's: spaces become U+2581, one is put before a text that is not empty, nothing else
is normalised, and code points without a piece become the pieces of their UTF-8 bytes. Words end before
each run of U+2581 and at code points without a piece, since no piece crosses these (checked for each
model: U+2581 must only lead a piece, and the code points of pieces must be pieces).
Decoding joins the pieces and takes the leading space off. U+2581 in a text comes back as a space.

One pass over the scan: no shuffle. Null and empty texts have no ids; a text of any length is encoded whole;
repeated rows are encoded alike; null ids stay null; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, claim, mixed
from .packing import texts_of

SPACE = "▁"
CACHED = 1_000_000
#: Words of one length that advance together in numpy at least, and code points that other words probe with at once.
TOGETHER, SPAN = 192, 1 << 15
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile("▁+[^▁\n]*|\n[^▁\n]*|[^▁\n]+")
_models: dict[str, Model] = {}


def _varint(raw: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (raw[i] & 127) << shift
        shift += 7
        i += 1
        if raw[i - 1] < 128:
            return value, i


def _fields(raw: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(field number, value) of a protocol buffer message."""
    i = 0
    while i < len(raw):
        key, i = _varint(raw, i)
        if key & 7 == 0:
            value, i = _varint(raw, i)
        else:
            n, i = _varint(raw, i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = raw[i : i + n], i + n
        yield key >> 3, value


class Model:
    """Pieces and scores of a model file; the kinds are 1 normal, 2 unknown, 3 control, 6 byte."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            own = [dict(_fields(v)) for k, v in _fields(f.read()) if k == 1]
        text = [p[1].decode() for p in own]
        score = np.array([struct.unpack("<f", p[2])[0] if 2 in p else 0.0 for p in own])
        kind = [p.get(3, 1) for p in own]
        normal = [i for i, k in enumerate(kind) if k == 1]
        self.single = {text[i]: i for i in normal if len(text[i]) == 1}
        for i in normal:
            if not set(text[i]) <= self.single.keys():
                raise ValueError(f"piece {i} has a code point that is no piece")
            if SPACE in text[i].lstrip(SPACE):
                raise ValueError(f"piece {i} crosses a word's start")
        self.byte = np.zeros(256, np.uint32)
        for i, k in enumerate(kind):
            if k == 6:
                self.byte[int(text[i][1:-1], 16)] = i
        self.raw = [bytes([int(t[1:-1], 16)]) if k == 6 else t.encode() if k == 1 else b"" for t, k in zip(text, kind, strict=True)]
        self.longest = max(len(text[i]) for i in normal)
        keys = np.array([self._hash(np.array([[ord(c) for c in text[i]]], np.uint64))[0] for i in normal])
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], np.array(normal, np.uint32)[order], score[normal][order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have the same hash")
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _hash(points: np.ndarray) -> np.ndarray:
        """Of each row of code points."""
        out = np.full(len(points), np.uint64(points.shape[1]))
        for k in range(points.shape[1]):
            out = out * _STEP + points[:, k] + np.uint64(1)
        return mixed(out)

    def viterbi(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words of equal length whose code points are all pieces."""
        n, m = len(words[0]), len(words)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(m, n).astype(np.uint64)
        best, size, piece = np.full((n + 1, m), -np.inf), np.zeros((n + 1, m), np.int64), np.zeros((n + 1, m), np.uint32)
        best[0] = 0
        sums = {length: np.full((n - length + 1, m), np.uint64(length)) for length in range(1, min(n, self.longest) + 1)}
        for length, out in sums.items():
            for k in range(length):
                out *= _STEP
                out += points.T[k : k + n - length + 1] + np.uint64(1)
        for end in range(1, n + 1):
            for length in range(min(end, self.longest), 0, -1):
                key = mixed(sums[length][end - length])
                at = np.searchsorted(self.keys, key)
                at[at == len(self.keys)] = 0
                total = np.where(self.keys[at] == key, best[end - length] + self.scores[at], -np.inf)
                better = total > best[end]
                best[end][better], size[end][better], piece[end][better] = total[better], length, self.ids[at[better]]
        out, at, columns = [np.zeros(0, np.uint32)] * m, np.full(m, n), np.arange(m)
        steps = []
        while (at > 0).any():
            steps.append(np.where(at > 0, piece[at, columns].astype(np.int64), -1))
            at = np.where(at > 0, at - size[at, columns], 0)
        back = np.array(steps[::-1]).T
        for i, row in enumerate(back):
            out[i] = row[row >= 0].astype(np.uint32)
        return out

    def each(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words of any lengths whose code points are all pieces: probed together, then advanced match by match."""
        size = [len(w) for w in words]
        start = np.cumsum([0, *(n + 1 for n in size)])  # a place between two words, so that the end of one is not the start of the next
        total = int(start[-1])
        best, back, piece = array("d", [-np.inf]) * total, array("B", [0]) * total, array("I", [0]) * total
        for at in start[:-1].tolist():
            best[at] = 0.0
        points = np.zeros(total + self.longest, np.uint64)
        points[:total] = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le"), "<u4")
        left = np.repeat(start[:-1] + size, np.array(size) + 1) - np.arange(total)  # code points from a place to its word's end
        for low in range(0, total, SPAN):
            rest, found = left[low : low + SPAN], []
            for length in range(1, self.longest + 1):
                at = np.flatnonzero(rest >= length)
                if not len(at):
                    break
                key = np.full(len(at), np.uint64(length))
                for k in range(length):
                    key = key * _STEP + points[low + at + k] + np.uint64(1)
                key = mixed(key)
                hit = np.searchsorted(self.keys, key)
                hit[hit == len(self.keys)] = 0
                good = self.keys[hit] == key
                found.append((low + at[good], np.full(int(good.sum()), length), self.scores[hit[good]], self.ids[hit[good]]))
            if not found:
                continue
            place, length, score, ids = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(place, kind="stable")
            for p, n, s, i in zip(place[order].tolist(), length[order].tolist(), score[order].tolist(), ids[order].tolist(), strict=True):
                s += best[p]
                if s > best[p + n]:  # of equal sums the longest piece, which comes first
                    best[p + n], back[p + n], piece[p + n] = s, n, i
        out = []
        for first, n in zip(start[:-1].tolist(), size, strict=True):
            own, at = array("I"), first + n
            while at > first:
                own.append(piece[at])
                at -= back[at]
            own.reverse()
            out.append(np.frombuffer(own, np.uint32) if own else np.zeros(0, np.uint32))
        return out

    def _learn(self, words: list[str]) -> None:
        plan: list[tuple[str, list]] = []
        by_size: dict[int, set[str]] = {}
        known = self.single
        for word in words:
            parts: list = [word]
            if not set(word) <= known.keys():
                parts, run = [], ""
                for c in word:
                    if c in known:
                        run += c
                    else:
                        parts += [run, c.encode()] if run else [c.encode()]
                        run = ""
                parts += [run] if run else []
            plan.append((word, parts))
            for p in parts:
                if isinstance(p, str):
                    by_size.setdefault(len(p), set()).add(p)
        found: dict[str, np.ndarray] = {}
        few: list[str] = []
        for size, group in by_size.items():
            group, step = list(group), max(1, (1 << 17) // size)
            if len(group) < TOGETHER or step < TOGETHER:
                few += group
                continue
            for low in range(0, len(group), step):
                found.update(zip(group[low : low + step], self.viterbi(group[low : low + step]), strict=True))
        ends = np.cumsum([len(w) for w in few])
        while few:  # some SPAN code points at a time, or one longer word
            k = max(1, int(np.searchsorted(ends, (ends[0] - len(few[0])) + SPAN, side="right")))
            found.update(zip(few[:k], self.each(few[:k]), strict=True))
            few, ends = few[k:], ends[k:]
        for word, parts in plan:
            self.cache[word] = b"".join(found[p].tobytes() if isinstance(p, str) else self.byte[list(p)].tobytes() for p in parts)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.cache) > CACHED:
            self.cache.clear()
        split, new, known = [self._words(t) for t in texts], set(), self.cache.__contains__
        for words in split:
            new.update(filterfalse(known, words))
        if new:
            self._learn(list(new))
        get = self.cache.__getitem__
        return [b"".join(map(get, words)) for words in split]

    @staticmethod
    def _words(text: str) -> list[str]:
        """Runs of U+2581 with what follows them; a newline begins a word of its own."""
        if not text:
            return []
        if text[0] == " " or "  " in text or SPACE in text:
            return _WORD.findall(SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE)).replace("\n", " \n").split(" ")

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text[:1] == " " else text


def model(path: str) -> Model:
    claim("pieces", _models.clear)
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


def _mapped(rows: DataFrame, path: str, id_col: str, columns: str, make) -> DataFrame:
    names = [id_col, *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for low, values in texts_of(batch.column(1)) if pa.types.is_string(batch.column(1).type) else [(0, batch.column(1).to_pylist())]:
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(values)), *make(own, values)], names=names)

    return bounded(rows).mapInArrow(run, f"`{id_col}` {rows.dtypes[0][1]}, {columns}")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_ids and the ids, little-endian unsigned 32-bit."""

    def make(own: Model, texts: list[str]) -> list[pa.Array]:
        ids = own.encode(texts)
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]

    return _mapped(docs.select(docs[id_col], docs[text_col].cast("string").alias("text")), path, id_col, "n_ids long, ids binary", make)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row of `encode`: id and the text."""
    return _mapped(encoded.select(id_col, "ids"), path, id_col, "text string", lambda own, ids: [pa.array([own.decode(x or b"") for x in ids], pa.string())])


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_ids, ids_crc32, n_byte_ids, and whether decoding gives the text again."""

    def make(own: Model, texts: list[str]) -> list[pa.Array]:
        ids = own.encode(texts)
        flat, is_byte = [np.frombuffer(x, "<u4") for x in ids], np.zeros(len(own.raw), bool)
        is_byte[own.byte] = True
        same = [own.decode(x) == t.replace(SPACE, " ") for x, t in zip(ids, texts, strict=True)]
        return [pa.array([len(x) for x in flat], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([int(is_byte[x].sum()) for x in flat], pa.int64()), pa.array(same)]

    return _mapped(docs.select(docs[id_col], docs[text_col].cast("string").alias("text")), path, id_col, "n_ids long, ids_crc32 long, n_byte_ids long, same boolean", make)
