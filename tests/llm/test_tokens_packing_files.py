"""Token ids, packing, Huffman files and pieces against the libraries and exact round trips."""

import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from atlasloom.llm import packing, pieces, token_files, tokens
from atlasloom.llm.registry import BYTE_BPE, PIECES, WORD_BPE

ALPHABET = list(" \n\t\r\x0b\x85 　abAB.,!'s1é́Σ中\x01\x1c\x1f​")
TEXTS = [None, "", " ", "\n", "  a", "a  b", "a \n b", "\n\nfoo", "I'm it's 's <|endoftext|> x", "a\n", "\na", " a\n \nb ", "word " * 5000, "x" * 20000]


def fuzz(n):
    rnd = random.Random(5)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize(("path", "style"), [(BYTE_BPE, "byte"), (WORD_BPE, "word")])
def test_cached_pieces_give_the_library_ids(path, style, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 300)
    own, texts = tokens.Encoder(path, style), fuzz(1500) + [t or "" for t in TEXTS]
    library = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    for low in range(0, len(texts), 100):
        got = own.encode(texts[low : low + 100])
        assert [np.frombuffer(x, own.dtype).tolist() for x in got] == [e.ids for e in library[low : low + 100]]


@pytest.mark.parametrize(("path", "style"), [(BYTE_BPE, "byte"), (WORD_BPE, "word")])
def test_merged_words_equal_the_library(path, style):
    own, rnd = tokens.Encoder(path, style), random.Random(11)
    assert (own.ranked if style == "byte" else own.ends) is not None and own.added
    letters = "abcdefghijklmnopqrstuvwxyzABCDÉéèüßøñłŐžșțİŉ'’.,!?()[]{}\"-_0123456789абвгёЯαβωひらカタ漢字龥가힣ǅʼ"
    words = ["".join(rnd.choices(letters, k=rnd.randint(1, 9))) for _ in range(20_000)] + ["'s", "'m,", "('ve", "l'storia", "x's", own.added[0], f"({own.added[0]})", "word,", "12.", "a1"]
    for lead in (" ", "") if style == "byte" else ("",):
        got = own._joined(words, lead)
        library = Tokenizer.from_file(path).encode_batch([lead + w for w in words], add_special_tokens=False)
        assert [np.frombuffer(x, own.dtype).tolist() for x in got] == [e.ids for e in library]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as start", "'x' as ids").repartition(3, "doc_id")


def library_ids(path, text):
    return np.array([*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_packing(spark):
    texts = TEXTS + fuzz(40)
    pieces_ = packing.pack(table(spark, texts), BYTE_BPE, "byte").collect()
    ids = {i: library_ids(BYTE_BPE, t) for i, t in enumerate(texts)}
    for r in pieces_:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert (r["ids_crc32"], r["doc_tokens"], bytes(r["ids"])) == (zlib.crc32(own.tobytes()), len(ids[r["doc_id"]]), own.tobytes())
    for i, own in ids.items():
        spans = sorted((r["start"], r["length"]) for r in pieces_ if r["doc_id"] == i)
        assert [s for s, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1]) and sum(n for _, n in spans) == len(own)
    lengths = {}
    for r in sorted(pieces_, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == lengths.get(r["sequence_id"], 0)
        lengths[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(lengths) == list(range(len(lengths)))
    assert all(n == packing.LENGTH for k, n in lengths.items() if k < len(lengths) - 1)
    whole = packing.sequences(packing.pack(table(spark, texts), BYTE_BPE, "byte")).collect()
    assert sum(r["used"] for r in whole) == sum(map(len, ids.values()))
    assert all(len(r["ids"]) == 4 * packing.LENGTH or r["used"] & (r["used"] - 1) == 0 for r in whole)


def test_packing_of_nothing_and_of_odd_rows(spark):
    assert packing.pack(table(spark, TEXTS).limit(0), BYTE_BPE).count() == 0
    odd = spark.createDataFrame([(None, "a"), (7, "same"), (7, "same")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in packing.pack(odd, BYTE_BPE).collect()) == ["7", "7", "None"]


def test_token_files_round_trip(spark, tmp_path):
    texts = TEXTS + fuzz(60)
    token_files.write_files(table(spark, texts), f"file://{tmp_path}/t", WORD_BPE)
    got = sorted(token_files.read_files(spark, f"file://{tmp_path}/t", with_ids=True).collect(), key=lambda r: r["doc_id"])
    start = 0
    for i, (r, t) in enumerate(zip(got, texts, strict=True)):
        own = library_ids(WORD_BPE, t)
        assert tuple(r) == (i, start, len(own), zlib.crc32(own.tobytes()), own.tobytes())
        start += len(own)
    blocks = spark.read.parquet(f"file://{tmp_path}/t/blocks").collect()
    docs = [d for b in sorted(blocks, key=lambda b: (b["part"], b["block"])) for d in b["docs"]]
    assert docs == sorted(docs)


def test_rows_that_share_an_id_spread_over_parts(spark, tmp_path):
    docs = spark.createDataFrame([(9, f"a text of words {i % 3}") for i in range(400)] + [(3, "b")], "doc_id long, text string").repartition(3)
    token_files.write_files(docs, f"file://{tmp_path}/h", WORD_BPE)
    got = sorted(token_files.read_files(spark, f"file://{tmp_path}/h").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [3] + [9] * 400 and [r["start"] for r in got] == list(np.cumsum([0] + [r["n_tokens"] for r in got])[:-1])
    ordered = token_files._tokens(docs, WORD_BPE, "word", 1, "doc_id", "text", f"file://{tmp_path}/t").where("hist is null").repartitionByRange(4, "doc", "part", "row")
    assert max(r["count"] for r in ordered.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()) < 250


def test_token_files_of_nothing_and_of_odd_rows(spark, tmp_path):
    token_files.write_files(table(spark, TEXTS).limit(0), f"file://{tmp_path}/e", WORD_BPE)
    assert token_files.read_files(spark, f"file://{tmp_path}/e").count() == 0
    odd = spark.createDataFrame([(3, "a"), (None, "b c"), (3, "a"), (1, None)], "doc_id long, text string")
    token_files.write_files(odd, f"file://{tmp_path}/o", WORD_BPE)
    got = sorted(token_files.read_files(spark, f"file://{tmp_path}/o").collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == [(None, 3), (1, 1), (3, 2), (3, 2)]


def huffman_cost(counts):
    import heapq

    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


def test_codes_are_optimal_within_the_limit():
    rnd = np.random.default_rng(1)
    for n in (2, 3, 17, 400):
        counts = rnd.integers(0, 1000, n) ** 2
        lengths = token_files.code_lengths(counts, 40)
        assert int((counts * lengths).sum()) == huffman_cost(counts.tolist())
    steep = np.array([1 << i for i in range(30)])
    lengths = token_files.code_lengths(steep, 8)
    assert lengths.max() <= 8 and abs(sum(2.0 ** -int(x) for x in lengths) - 1) < 1e-12


@pytest.mark.parametrize("n", [1, 2, 511, 512, 513, 5000])
def test_block_round_trip(n):
    rnd = np.random.default_rng(n)
    counts = np.zeros(3000, np.int64)
    counts[rnd.integers(0, 3000, 700)] = rnd.integers(1, 1 << 20, 700)
    lengths = token_files.code_lengths(counts)
    ids = rnd.choice(np.flatnonzero(counts), n)
    payload, marks = token_files.encode_block(ids, lengths, token_files.canonical(lengths))
    assert (token_files.Table(lengths).decode(payload, marks, n) == ids).all()


def test_one_used_id():
    lengths = token_files.code_lengths(np.array([0, 5]))
    payload, marks = token_files.encode_block(np.ones(1000, int), lengths, token_files.canonical(lengths))
    assert (token_files.Table(lengths).decode(payload, marks, 1000) == 1).all()


@pytest.fixture(scope="module")
def model():
    return pieces.Model(PIECES)


def best_total(model, word):
    """The best sum of scores by a plain dynamic programme."""
    by_id = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    score = {model.raw[i].decode(): i for i in by_id}
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - model.longest), end):
            if (i := score.get(word[start:end])) is not None:
                best[end] = max(best[end], best[start] + by_id[i])
    return best[-1]


def test_viterbi_is_optimal(model):
    rnd = random.Random(2)
    words = ["▁" + "".join(rnd.choices("theaionrst", k=rnd.randint(1, 14))) for _ in range(400)] + ["▁▁▁the", "▁", "the"]
    by_id = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    for word in words:
        ids = model.viterbi([word])[0]
        assert b"".join(model.raw[i] for i in ids).decode() == word
        assert sum(by_id[int(i)] for i in ids) == best_total(model, word)


def test_words_advance_together(model):
    words = [w for w in {w for t in fuzz(300) for w in t.split()} if len(w) == 5 and set(w) <= model.single.keys()]
    assert [x.tolist() for x in model.viterbi(words)] == [model.viterbi([w])[0].tolist() for w in words]


def test_words_of_any_lengths_advance_alike(model, monkeypatch):
    rnd = random.Random(8)
    words = [w for w in {"".join(rnd.choices("abcdefgh0123+/AB", k=rnd.randint(1, 60))) for _ in range(300)} if set(w) <= model.single.keys()] + ["▁" * 40, "a"]
    want = [model.viterbi([w])[0].tolist() for w in words]
    for span in (11, 1 << 15):
        monkeypatch.setattr(pieces, "SPAN", span)
        assert [x.tolist() for x in model.each(words)] == want
    blob = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/", k=300_000))
    assert model.decode(model.encode([blob])[0]) == blob


def test_library_agrees_where_it_is_optimal(model):
    spm = pytest.importorskip("sentencepiece")
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb.ModelProto()
    proto.ParseFromString(open(PIECES, "rb").read())
    proto.trainer_spec.model_type = 1  # read the pieces as a unigram model
    library = spm.SentencePieceProcessor(model_proto=proto.SerializeToString())
    by_id = dict(zip(model.ids.tolist(), model.scores.tolist(), strict=True))
    rnd = random.Random(4)
    same = total = 0
    for _ in range(300):
        word = "".join(rnd.choices("abcdefghilmnoprstu", k=rnd.randint(1, 9)))
        mine, theirs = np.frombuffer(model.encode([word])[0], "<u4").tolist(), library.encode(word)
        total += 1
        same += mine == theirs
        assert sum(by_id[i] for i in mine) >= sum(by_id[i] for i in theirs)
    assert same >= 0.9 * total


def test_pieces_round_trip(spark, model):
    texts = TEXTS + fuzz(200) + ["with ▁ mark", "中文龘 \U0001f600"]
    encoded = pieces.encode(table(spark, texts).select("doc_id", "text"), PIECES)
    back = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, PIECES).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert all(r["same"] for r in pieces.round_trip(table(spark, texts), PIECES).collect())
    assert pieces.round_trip(table(spark, texts).limit(0), PIECES).count() == 0


def test_paths_are_the_public_files():
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE
