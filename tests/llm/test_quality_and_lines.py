"""Quality rules and line dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from atlasloom.llm import line_dedup, quality, shingles, words

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LONG = "this line is repeated in very many documents of all"
TEXTS = [
    None, "", " ", "\n", "one", "a b c d e f g h i j k", "w " * 30, "x y z\nx y z\n\nx y z", "é é é é é é é é é é é é", "tab\tand\x0bothers\x0c# $%",
    "q r s t u v q r s t u v 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28 29", LONG + "\n" + LONG, " \t" + LONG.upper() + " \r\nend", "é" * 40 + "\nshort", "a" * 300_000,
    " ".join(str(i) for i in range(3000)) + "\n" + " ".join(str(i) for i in range(500)), "nbsp is no space here,   neither", "#" * 50,
]


def brute_quality(text, rules=quality.Rules()):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    chars = sum(map(len, words))
    seen, dup, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            if line in seen:
                dup += 1
                dup_chars += len(re.sub(r"[\x20\x09-\x0D]", "", line))
            seen.add(line)
    bad = 100 * dup_chars > rules.lines * chars
    first = None
    for n, limit in rules.coverage:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        count = Counter(grams)
        inside = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + n)}
        covered = sum(len(words[j]) for j in inside)
        first = first or (len(inside), covered)
        bad |= 100 * covered > limit * chars
    base = len(words) < 10 or 100 * first[0] > 20 * len(words)
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), dup, first[0], base, not base and not bad, dup_chars, first[1])


def rows(spark, texts, extra=""):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("doc_id", "text", "'clash' as n_words", "cast(null as string) as kept", "length(text) as n_chars")


def test_quality_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.quality_scores(rows(spark, TEXTS)).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(TEXTS)}


def test_quality_across_slices(spark, monkeypatch):
    monkeypatch.setattr("atlasloom.llm.common.SLICE_BYTES", 64)
    import numpy as np
    import pyarrow as pa

    whole = quality.measured(pa.array(TEXTS), quality.Rules())
    parts = [quality.measured(pa.array([t]), quality.Rules()) for t in TEXTS]
    for c in quality.COLUMNS:
        assert (whole[c] == np.concatenate([p[c] for p in parts])).all()


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    import random

    import numpy as np
    import pyarrow as pa

    rnd = random.Random(1)
    texts = ["".join(rnd.choices("ab \n", k=rnd.randint(0, 300))) for _ in range(50)] + ["x" * 1000, "a " * 700, ""]
    want = [list(shingles.shingle_sets(pa.array(texts))), quality.measured(pa.array(texts), quality.Rules())]
    for block in (1, 7, 64, 1000):
        monkeypatch.setattr(words, "BLOCK", block)
        got = list(shingles.shingle_sets(pa.array(texts)))
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(want[0], got, strict=True))
        found = quality.measured(pa.array(texts), quality.Rules())
        assert all((found[c] == want[1][c]).all() for c in quality.COLUMNS)
    monkeypatch.setattr(words, "BLOCK", 1 << 16)
    words._powers.clear()
    text = " ".join(str(i % 9973) for i in range(700_000))  # 3.4 MB
    own = quality.measured(pa.array([text]), quality.Rules())
    assert own["n_words"][0] == 700_000 and own["base_failed"][0] and len(next(shingles.shingle_sets(pa.array([text])))) == 9973
    assert max(map(len, words._powers.values())) <= (1 << 16) + 1
    words._powers.clear()


def test_keep_good_keeps_all_columns_of_clean_documents(spark):
    docs = rows(spark, TEXTS)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if brute_quality(t)[6]}


@pytest.mark.parametrize("operator", [quality.quality_scores, quality.keep_good, line_dedup.line_report, line_dedup.dedup_lines])
def test_empty_table(spark, operator):
    assert operator(rows(spark, TEXTS).limit(0)).count() == 0


def brute_lines(docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))

    holders, out = defaultdict(list), {}
    for i, t in docs:
        for k in {key(line) for line in (t or "").split("\n")}:
            holders[k].append(i)
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 40 and len(holders[key(x)]) >= 5 and i is not None and i < max(h for h in holders[key(x)] if h is not None))]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def many():
    texts = TEXTS + [f"{LONG}\nown line number {i} which is long enough to count here" for i in range(6)] + ["z\n" + LONG + "\n" + "é" * 39] * 2 + ["é" * 40] * 5
    return list(enumerate(texts))


def test_lines_equal_brute_force(spark):
    docs = spark.createDataFrame(many(), "doc_id long, text string").selectExpr("*", "'x' as key", "1 as drops", "'y' as _doc", "'z' as _drops", "length(text) as n_chars")
    got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.line_report(docs).collect()}
    assert got == brute_lines(many())
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    for r in kept.collect():
        assert hashlib.sha256((r["text"] or "").encode()).hexdigest() == got[r["doc_id"]][2]
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_lines_of_rows_without_id_and_of_repeated_ids(spark):
    docs = spark.createDataFrame([(None, LONG)] * 3 + [(1, LONG), (2, LONG), (2, LONG)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in line_dedup.line_report(docs).collect())
    assert got == [(0, 0), (0, 0), (0, 0), (1, 1), (2, 0), (2, 0)]


def test_documents_with_a_line_are_counted_by_id(spark):
    other = LONG + " and more"
    docs = spark.createDataFrame([(1, LONG)] + [(2, LONG)] * 4 + [(i, other) for i in range(10, 14)] + [(14, other)] * 2 + [(None, other + "!")] * 3 + [(20, other + "!")] * 3, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in line_dedup.line_report(docs).collect())
    assert got == sorted([(1, 0)] + [(2, 0)] * 4 + [(i, 1) for i in range(10, 14)] + [(14, 0)] * 2 + [(0, 0)] * 3 + [(20, 0)] * 3)
