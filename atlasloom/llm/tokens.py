"""Token ids of whole texts through the tokenizers library, each distinct word encoded once per worker.

Texts are cut only where the tokenizer's own pre-tokenizer always cuts, so joining the pieces' ids gives
the ids of the whole text:

* byte-level BPE: before a single space or newline between two other characters, and around runs of
  white space the way the pre-tokenizer itself splits them;
* BPE with word ends, white space dropped: at white space.

Texts with the four separators U+001C..U+001F, on which white space definitions differ, are encoded whole.

Byte-level BPE merges the pair of least rank first. Where a file's merges are its tokens in ascending order, each token
by one merge, the ranks of tokens say the same, and a word of letters (or digits) with ASCII signs around it is merged by
tiktoken's engine, a word at a time; the pre-tokenizer cuts such a word at its signs in every version of Unicode. BPE with
word ends is the same over words that end in a byte no UTF-8 text has, whose merges with the last byte come before all
others; its normaliser lower-cases such words and its pre-tokenizer cuts digits apart. All other pieces go through the tokenizers
library itself.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from itertools import filterfalse

import numpy as np

from .common import claim

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: Cached pieces per worker: beyond it a new cache begins, into which pieces of the old one move when they
#: are met again. A bound on memory alone: the ids do not depend on it.
CACHED = 640_000
_DISPUTED = "\x1c\x1d\x1e\x1f"
_RUN = re.compile(r"\s\s")
_PLAIN = re.compile("[^\\s\x01\x1e]+").fullmatch
_PIECE = re.compile(r"\s+(?!\S)|\s?\S+|\s+")
_encoders: dict[tuple[str, str], Encoder] = {}
#: Signs, then letters that have been letters since Unicode 3 or digits, then signs.
_SIGNS = r"([!-/:-@\[-`{-~]*)"
_SIMPLE = re.compile(_SIGNS + "([A-Za-zÀ-ÖØ-öø-ɏА-яЁёα-ωぁ-んァ-ヴ一-龥가-힣]+|[0-9]+)" + _SIGNS).fullmatch


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters for themselves, the others in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(rest)}


#: The normaliser and the cutting pattern of files with word ends that are known to treat simple words as said above.
_WORD_FORMS = ["NFC", "Replace", "Lowercase"], r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END, _SUFFIX = 0xFF, "</w>"


def _engine(ranks: dict[bytes, int]) -> Callable[[bytes], list[int]]:
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


def _ascending(model: dict) -> list[str] | None:
    """What the merges make, in order, if these are tokens with ascending ids."""
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"].get(t) for t in made]
    return None if None in ids or any(a >= b for a, b in zip(ids[:-1], ids[1:], strict=True)) else made


def _ranked_ends(path: str) -> tuple[Callable[[bytes], list[int]], list[int]] | None:
    """(ranks of a word's bytes and _END, the id of each rank) for BPE with word ends, if the file allows it."""
    with open(path) as f:
        spec = json.load(f)
    model, alphabet = spec["model"], byte_alphabet()
    odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "unk_token"))
    forms = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if odd or model.get("type") != "BPE" or model.get("end_of_word_suffix") != _SUFFIX or forms != _WORD_FORMS[0] or len(cut) != 2:
        return None
    if cut[0].get("type") != "Split" or (cut[0].get("pattern") or {}).get("Regex") != _WORD_FORMS[1] or not cut[0].get("invert") or cut[0].get("behavior") != "Removed" or cut[1].get("type") != "ByteLevel" or cut[1].get("use_regex") or cut[1].get("add_prefix_space"):
        return None
    vocab, made = model["vocab"], _ascending(model)
    if made is None or not all(c in vocab and c + _SUFFIX in vocab for c in alphabet):
        return None
    ranks, ids = {}, [0] * (512 + len(made))
    for c, b in alphabet.items():
        ranks[bytes([b, _END])], ids[b] = b, vocab[c + _SUFFIX]
        ranks[bytes([b])], ids[256 + b] = 256 + b, vocab[c]
    for k, t in enumerate(made):
        ended = t.endswith(_SUFFIX)
        raw = bytes(alphabet[c] for c in (t.removesuffix(_SUFFIX) if ended else t)) + bytes([_END] * ended)
        if raw in ranks:
            return None
        ranks[raw], ids[512 + k] = 512 + k, vocab[t]
    try:
        return _engine(ranks), ids
    except ImportError:
        return None


def _ranked(path: str) -> Callable[[bytes], list[int]] | None:
    """Ids of a word's bytes by ranks of tokens, if the file allows it."""
    with open(path) as f:
        spec = json.load(f)
    model, shape = spec["model"], spec.get("pre_tokenizer") or {}
    odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if odd or model.get("type") != "BPE" or spec.get("normalizer") or shape.get("type") != "ByteLevel" or shape.get("add_prefix_space") or not shape.get("use_regex", True):
        return None
    vocab, alphabet, made = model["vocab"], byte_alphabet(), _ascending(model)
    if made is None:
        return None
    merged = [vocab[t] for t in made]
    whole = {t: i for t, i in vocab.items() if all(c in alphabet for c in t)}
    singles = {t: i for t, i in whole.items() if len(t) == 1}
    if len(singles) != 256 or max(singles.values()) >= merged[0] or set(whole.values()) != set(singles.values()) | set(merged):
        return None  # tokens that no merge makes would be merged all the same
    try:
        return _engine({bytes(alphabet[c] for c in t): i for t, i in whole.items()})
    except ImportError:
        return None


class Encoder:
    """style: "byte" or "word"."""

    def __init__(self, path: str, style: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.style = Tokenizer.from_file(path), style
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() < 1 << 16 else np.dtype("<u4")
        self.separator = "\n" if style == "byte" else " \x01 "
        mark = self._whole(["\n" if style == "byte" else "\x01"])[0]
        self.mark = int(np.frombuffer(mark, self.dtype)[0]) if len(mark) == self.dtype.itemsize else None
        self.ranked = _ranked(path) if style == "byte" else None
        self.ends = _ranked_ends(path) if style == "word" else None
        self.signs: dict[str, list[int]] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(x.isalnum() for x in self.added):
            self.ranked = self.ends = None
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # the library's own word cache only costs time below this one

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, pieces: list[str], lead: str) -> list[bytes]:
        """Ids of pieces without white space, each after `lead`."""
        if self.ends is not None:
            return self._filled(pieces, lead, self._ended(pieces))
        if self.ranked is None:
            return self._together(pieces, lead)
        merge, simple, code, held, added = self.ranked, _SIMPLE, "H" if self.dtype.itemsize == 2 else "I", self.signs, self.added
        found: list[bytes | None] = []
        for p in pieces:
            parts = simple(p)
            if parts is None:
                found.append(None)
                continue
            before, core, after = parts.groups()
            # where a shortened word may begin, or an added token stands, the library decides
            if (before == "'" and not lead) or ((before or after) and any(x in p for x in added)):
                found.append(None)
                continue
            if before:
                ids = merge((lead + before).encode()) + merge(core.encode())
            else:
                ids = merge((lead + core).encode())
            if after:
                if after not in held and len(held) < 4096:
                    held[after] = merge(after.encode())
                ids = ids + (held[after] if after in held else merge(after.encode()))
            found.append(array(code, ids).tobytes())
        return self._filled(pieces, lead, found)

    def _ended(self, pieces: list[str]) -> list[bytes | None]:
        """Ids of simple pieces by BPE with word ends; None for the others."""
        (merge, ids), simple, code, held, added = self.ends, _SIMPLE, "H" if self.dtype.itemsize == 2 else "I", self.signs, self.added
        found: list[bytes | None] = []

        def sign(text: str) -> list[int]:
            if text not in held and len(held) < 4096:
                held[text] = merge(text.encode() + b"\xff")
            return held[text] if text in held else merge(text.encode() + b"\xff")

        for p in pieces:
            parts = simple(p)
            if parts is None:
                found.append(None)
                continue
            before, core, after = parts.groups()
            low = core.lower()
            # where a shortened word may begin, an added token stands, or a letter becomes two, the library decides
            if before == "'" or len(low) != len(core) or ((before or after) and any(x in p for x in added)):
                found.append(None)
                continue
            ranks = merge(low.encode() + b"\xff") if not "0" <= core[0] <= "9" else [r for d in core for r in sign(d)]
            if before:
                ranks = sign(before) + ranks
            if after:
                ranks = ranks + sign(after)
            found.append(array(code, [ids[r] for r in ranks]).tobytes())
        return found

    def _filled(self, pieces: list[str], lead: str, found: list[bytes | None]) -> list[bytes]:
        """`found` with the library's ids where there are none yet."""
        rest = [i for i, x in enumerate(found) if x is None]
        for i, ids in zip(rest, self._together([pieces[i] for i in rest], lead) if rest else [], strict=True):
            found[i] = ids
        return found

    def _together(self, pieces: list[str], lead: str) -> list[bytes]:
        """Ids of pieces without white space, each after `lead`: encoded as one text with separators between."""
        if self.mark is None or len(pieces) < 2:
            return self._whole([lead + p for p in pieces])
        ids = np.array(self.tokenizer.encode_batch_fast([lead + (self.separator + lead).join(pieces)], add_special_tokens=False)[0].ids, self.dtype)
        at = np.flatnonzero(ids == self.mark)
        if len(at) != len(pieces) - 1:
            return self._whole([lead + p for p in pieces])
        raw, size = ids.tobytes(), self.dtype.itemsize
        return [raw[a:b] for a, b in zip([0, *((at + 1) * size).tolist()], [*(at * size).tolist(), len(raw)], strict=True)]

    def _learn(self, keys: list[str]) -> None:
        plain = list(filter(_PLAIN, keys))
        lead = " " if self.style == "byte" else ""
        for low in range(0, len(plain), 8192):
            part = plain[low : low + 8192]
            self.cache.update(zip(part, self._joined(part, lead), strict=True))
        if len(plain) < len(keys):
            odd = list(filterfalse(_PLAIN, keys))
            marked = [k for k in odd if self.style == "byte" and self.mark is not None and k[:1] in ("\n", "\x1e") and _PLAIN(k[1:])]
            newline = np.array([self.mark or 0], self.dtype).tobytes()
            for key, ids in zip(marked, self._joined([k[1:] for k in marked], "") if marked else [], strict=True):
                self.cache[key] = newline + ids if key[0] == "\n" else ids
            odd = list(set(odd).difference(marked))
            self.cache.update(zip(odd, self._whole([self._literal(k) for k in odd]) if odd else [], strict=True))

    def _literal(self, key: str) -> str:
        """The text that a key of the byte style stands for: a space comes before it unless marked otherwise."""
        if self.style == "word":
            return key
        return key[1:] if key[:1] == "\x1e" else key if key[:1] == "\n" else " " + key

    def _pieces(self, text: str) -> list[str]:
        if self.style == "word":
            return text.split()
        if not _RUN.search(text):
            found = text.replace("\n", " \n").split(" ")
            found[0] = "\x1e" + found[0]
            return found
        return [p[1:] if p[0] == " " and len(p) > 1 and p[1] > " " and not p[1].isspace() else p if p[0] == "\n" and len(p) > 1 and not p[1].isspace() else "\x1e" + p for p in _PIECE.findall(text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian in `dtype`."""
        disputed = {i for i, t in enumerate(texts) if any(c in t for c in _DISPUTED)}
        parts = [[] if i in disputed else self._pieces(t) for i, t in enumerate(texts)]
        if len(self.cache) > CACHED:
            self.older, self.cache = self.cache, {}
        known, new = self.cache.__contains__, set()
        for p in parts:
            new.update(filterfalse(known, p))
        if self.older:
            again = new & self.older.keys()
            self.cache.update(zip(again, map(self.older.__getitem__, again), strict=True))
            new -= again
        if new:
            self._learn(list(new))
        get = self.cache.__getitem__
        out = [b"".join(map(get, p)) for p in parts]
        for i, ids in zip(sorted(disputed), self._whole([texts[i] for i in sorted(disputed)]) if disputed else [], strict=True):
            out[i] = ids
        return out


def encoder(path: str, style: str) -> Encoder:
    """One encoder per worker and file; workers are reused across tasks, and another operator's first task there frees it."""
    claim("tokens", _encoders.clear)
    if (path, style) not in _encoders:
        _encoders[path, style] = Encoder(path, style)
    return _encoders[path, style]
