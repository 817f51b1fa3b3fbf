"""Quality rules by repetition coverage.

Rolling hashes of 5 to 10 words (numpy, one slice of texts at a time) find the n-grams that a text holds
twice or more; the characters inside them, and those of repeated lines, are measured against all
characters in words. Longer n-grams are looked for only where a repeated 5-gram starts, since a repeated
n-gram starts with one.

Everything is local to a row: one pass over the scan, no shuffle, no state beyond one slice. Null and
empty texts have no words (base_failed). Repeated rows are judged alike, and a null doc_id stays null.
Other columns pass through `keep_good` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, cast_id, claim, mixed, slices, text_buffers, within
from .words import Texts, repeated

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MULTIPLIER = 0xD6E8FEB86659FD93


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict, in percent of the characters in words; a document over any of them goes."""

    least_words: int = 10
    repeat_words: int = 20
    coverage: tuple[tuple[int, int], ...] = ((5, 20), (6, 19), (7, 18), (8, 17), (9, 16), (10, 15))
    lines: int = 30


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_chars", "dup_gram_chars")


def _covered(start: np.ndarray, n: int, total: int) -> np.ndarray:
    """Whether each word lies in a window of n words that begins at one of the starts."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, start, 1)
    np.subtract.at(edge, start + n, 1)
    return np.cumsum(edge[:-1]) > 0


def measure(raw: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """The columns of COLUMNS for the texts of one slice."""
    texts = Texts(raw, offsets)
    rows, low, high = texts.rows, offsets[:-1], offsets[1:]
    words = texts.words()
    leads = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=leads[1:])
    chars = leads[words.end] - leads[words.start]
    bounds = np.searchsorted(words.row, np.arange(rows + 1))
    n_words = np.diff(bounds)
    word_chars = within(chars, bounds[:-1], bounds[1:])

    lines = texts.lines()
    filled = within(~texts.space, lines.start, lines.end) > 0
    key = mixed(lines.value + lines.row.astype(np.uint64) * np.uint64(_MULTIPLIER))
    order = np.argsort(key, kind="stable")
    order = order[filled[order]]
    again = order[1:][key[order[1:]] == key[order[:-1]]]
    n_dup_lines = np.bincount(lines.row[again], minlength=rows)
    dup_line_chars = np.bincount(lines.row[again], within((~texts.space) & ((raw & 0xC0) != 0x80), lines.start[again], lines.end[again]), minlength=rows).astype(np.int64)

    failed_by = 100 * dup_line_chars > rules.lines * word_chars
    total, salt = len(words.row), words.row.astype(np.uint64) * np.uint64(_MULTIPLIER)
    ends = bounds[1:][words.row] if total else np.zeros(0, np.int64)
    n_repeat_words = dup_gram_chars = np.zeros(rows, np.int64)
    at, value, n = np.arange(total), np.zeros(total, np.uint64), 0
    for size, limit in rules.coverage:
        fits = at + size <= ends[at]
        at, value = at[fits], value[fits]
        while n < size:
            value = value * np.uint64(_MULTIPLIER) + words.value[at + n]
            n += 1
        twice = repeated(mixed(value ^ salt[at]))
        at, value = at[twice], value[twice]
        inside = _covered(at, size, total)
        got = within(chars * inside, bounds[:-1], bounds[1:])
        if size == rules.coverage[0][0]:
            n_repeat_words, dup_gram_chars = within(inside, bounds[:-1], bounds[1:]), got
        failed_by |= 100 * got > limit * word_chars
    base = (n_words < rules.least_words) | (100 * n_repeat_words > rules.repeat_words * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": within(_SYMBOL[raw], low, high), "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words, "base_failed": base, "kept": ~(base | failed_by),
        "dup_line_chars": dup_line_chars, "dup_gram_chars": dup_gram_chars,
    }


def measured(texts: pa.Array, rules: Rules) -> dict[str, np.ndarray]:
    raw, offsets = text_buffers(texts)
    parts = [measure(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], rules) for a, b in slices(offsets)]
    return {c: np.concatenate([p[c] for p in parts]) for c in COLUMNS} if parts else {}


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """One row per document: its id and the columns of COLUMNS."""
    rules = rules or Rules()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        for batch in batches:
            if batch.num_rows:
                found = measured(batch.column(1), rules)
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[c]) for c in COLUMNS)], names=[id_col, *COLUMNS])

    kinds = ", ".join(f"{c} {'boolean' if c in ('base_failed', 'kept') else 'long'}" for c in COLUMNS)
    return bounded(docs).select(cast_id(docs, id_col), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"`{id_col}` long, {kinds}")


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules | None = None) -> DataFrame:
    """The documents whose verdict is kept, with all their columns."""
    rules, at = rules or Rules(), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(measured(batch.column(at), rules)["kept"]))

    return bounded(docs).mapInArrow(run, docs.schema)
