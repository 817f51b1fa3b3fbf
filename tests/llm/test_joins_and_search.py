"""The Jaccard join, top-k search, licence scans, URL filters, chat formatting and the pipeline."""

import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from atlasloom.llm import chat, common, components, jaccard, licenses, line_dedup, oracles, packing, quality, topk, url_filters

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_groups(docs):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted, shared = defaultdict(list), Counter()
    for d, s in sets.items():
        for x in s:
            inverted[x].append(d)
    for held in inverted.values():
        for i, a in enumerate(held):
            for b in held[i + 1 :]:
                shared[min(a, b), max(a, b)] += 1
    for (a, b), k in shared.items():
        if 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def family(seed, words, copies, change):
    """A text, chains of copies of copies, and unrelated texts that share a passage with it."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(words)]
    out, last = [" ".join(base)], base
    for _ in range(copies):
        last = list(last)
        for _ in range(change):
            last[rnd.randrange(len(last))] = f"n{rnd.randint(0, 10**6)}"
        out.append(" ".join(last))
    return out + [" ".join([f"o{rnd.randint(0, 10**6)}" for _ in range(words)] + base[:55]) for _ in range(6)]


def corpus():
    texts = [None, "", "  \n", "a b", "A  b", "a b c", "a b c d e", "x a b c d e", "A B c d e", "t " * 400]
    for seed, (words, copies, change) in enumerate([(12, 6, 1), (16, 8, 1), (30, 8, 1), (60, 30, 2), (120, 10, 4), (300, 6, 9), (9, 5, 1), (7, 5, 1)]):
        texts += family(seed, words, copies, change)
    rnd = random.Random(9)
    small = [f"s{i}" for i in range(8)]
    texts += [" ".join(small[i % 8] for i in range(rnd.randint(5, 14))) + f" e{rnd.randint(0, 2)}" for _ in range(60)]
    texts += [texts[40]] * 20 + ["the same text of six words"] * 30
    rnd.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("short", "light", "often", "hot"), [(48, None, 12, 1000), (3, None, 10**6, 4), (6, 0, 2, 1000), (3, 12, 12, 2)])
def test_groups_equal_brute_force(spark, monkeypatch, short, light, often, hot):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "MEMBERS", 512 if hot == 1000 else 5)
    monkeypatch.setattr(jaccard, "COMMON", often)
    monkeypatch.setattr(common, "LEAST_HOT", hot)
    if hot < 1000:  # components by joins, an order cut short, a bit table that is nearly full, keys combined in many parts
        monkeypatch.setattr(components, "PER_TASK", 50)
        monkeypatch.setattr(common, "HOT_KEYS", 10**6)
        monkeypatch.setattr(jaccard, "ORDERED", 7)
        monkeypatch.setattr(jaccard, "TABLE_BITS", 1 << 16)
    if light is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda sizes: light)
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").selectExpr("*", "1 as n", "'k' as key", "'a' as print")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.groups(docs).collect()}
    assert got == brute_groups(corpus())


@pytest.mark.parametrize(("light", "common"), [(None, 12), (0, 2), (12, 12)])
def test_all_links_equal_brute_force(spark, monkeypatch, light, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    if light is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda sizes: light)
    base = [f"v{i}" for i in range(200)]
    texts = corpus() + [(10_000 + i, " ".join([*base[: 6 * i], "changed", *base[6 * i + 1 :]])) for i in range(30)]
    first = {}
    for d, t in texts:
        first.setdefault(shingles(t), d)
    want = set()
    for a, x in first.items():
        for b, y in first.items():
            if x < y and 100 * len(a & b) >= 75 * len(a | b):
                want.add((x, y, len(a & b), len(a | b)))
    got = [tuple(r) for r in jaccard.all_links(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    _, part, _ = jaccard.links(spark.createDataFrame(texts, "doc_id long, text string"))
    assert part.join(spark.createDataFrame([r[:2] for r in got], "a long, b long"), ["a", "b"], "left_semi").count() < len(got) - 300


def changed(words, counts, seed):
    """Copies of one text with so many words changed, five or more words apart."""
    rnd = random.Random(seed)
    out = []
    for k in counts:
        own = [f"b{i}" for i in range(words)]
        for at in rnd.sample(range(5, words - 5, 6), k):
            own[at] = f"c{rnd.randint(0, 10**9)}"
        out.append(" ".join(own))
    return out


def test_lists_leave_out_entries_too_late_for_any_pair(spark):
    docs = spark.createDataFrame(list(enumerate(changed(150, [5] * 60, 3))), "doc long, text string")
    *_, lists, _ = jaccard._lists(docs, common.workspace(spark))
    assert lists.count() == 0
    texts = [t for words in (150, 156, 165, 180, 190) for t in changed(words, [0, 1, 2, 3, 3, 4, 4, 5, 6, 7], words)]
    rows = [(7 * i + 2, t) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_groups(rows) and 1 < len({c for _, c in got.values()}) < len(rows)


def test_keep_one_keeps_one_row_of_each_group(spark):
    """Nameless rows go if a document with an id is like them, else one of them stays; of rows with one id one stays."""
    base = " ".join(f"q{i}" for i in range(40))
    more = [(None, "a b c d e"), (None, base), (None, base), (None, base + " more"), (None, "  "), (None, None), (7001, "z1 z2 z3 z4 z5 z6"), (7001, "z1 z2 z3 z4 z5 z6"), (7002, "y1 y2 y3 y4 y5 y6"), (7002, "z1 z2 z3 z4 z5 z6"), (7002, "")]
    rows = [*corpus(), *more]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as node", "2 as component", "'r' as row", "1 as _node", "1 as _gone")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    texts = dict(corpus())
    want = Counter((c, texts[c]) for c in {c for _, c in brute_groups(corpus()).values()})
    rest = got - want
    assert not want - got and rest.pop((None, "  ")) == rest.pop((None, None)) == rest.pop((7002, "")) == 1
    assert sorted((str(i), n) for (i, _), n in rest.items()) == [("7001", 1), ("None", 1)] and all((t or "")[0] in "qz" for _, t in rest)


def test_jaccard_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.groups(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "g h i j k l"), (4, "g h i j k l"), (9, None)], "doc_id long, text string")
    assert sorted(map(str, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.groups(odd).collect()))) == sorted(map(str, [(None, 2, None), (5, 2, 4), (5, 2, 4), (4, 2, 4), (9, 0, 9)]))


def test_boundary_takes_the_cheaper_side():
    assert jaccard.boundary({}) == 0
    assert jaccard.boundary({3: 1000}) >= 3
    assert jaccard.boundary({12: 10**6, 11: 10**6}) < 12


@pytest.mark.parametrize("share", [1 << 19, 40])
def test_components_of_long_chains_and_stars(spark, tmp_path, monkeypatch, share):
    monkeypatch.setattr(components, "PER_TASK", share)  # one task, or rounds of joins with hot nodes
    monkeypatch.setattr(common, "LEAST_HOT", 3)
    monkeypatch.setattr(common, "HOT_KEYS", 10**6)
    links = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 60)] + [(900, 901), (901, 900), (902, 902)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long").repartition(7), f"file://{tmp_path}/c").collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{500 + i: 500 for i in range(1, 60)}, 901: 900}


def test_top_k_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(16)]) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(20)] + [(50, [])] + [(2000 + i, []) for i in range(3)] + [(2050, [])] + [(1000, None), (1001, [1.0, None] * 8), (1002, [float("nan")] * 16), (1003, [float("inf")] * 16), (1004, []), (1005, [0.1] * 4), (1006, [0.0] * 16), (None, [0.5] * 16), (0, rows[7][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "'r' as rank").repartition(3)
    exact = {}
    for r in frame.collect():
        e = r["embedding"]
        if r["vec_id"] is not None and e is not None and all(x is not None and abs(x) < 1e30 for x in e):
            exact.setdefault(r["vec_id"], []).append([int((256 * x) // 1) for x in e])
    got = defaultdict(list)
    for r in sorted(topk.top_k(frame, frame.where("vec_id % 50 = 0")).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    want = {}
    for q in exact:
        if q % 50 == 0:  # 0, 50 and 1000 have several vectors: a candidate counts with its best score
            found = [(-max(sum(a * b for a, b in zip(e, v, strict=True)) for e in exact[q] if len(e) == len(v)), i) for i, vs in exact.items() if i != q for v in vs if any(len(e) == len(v) for e in exact[q])]
            want[q] = [(-s, i) for s, i in sorted(found)[:5]]
    assert len(exact[0]) == len(exact[50]) == 2
    assert dict(got) == {q: w for q, w in want.items() if w}
    assert topk.top_k(frame.limit(0), frame.limit(0)).count() == 0


def test_proofs_end_some_queries_early_and_not_others():
    rnd = np.random.default_rng(2)

    def block(cells):
        return topk.Block(np.arange(len(cells), dtype="<i8").tobytes(), topk._packed(cells.T), np.argsort(cells, axis=0, kind="stable").T.astype("<u2").tobytes(), cells.shape[1])

    def brute(cells, query, own):
        return sorted((-int(v @ query), i) for i, v in enumerate(cells) if i != own)[:5]

    steep = (rnd.normal(size=(4000, 32)) * np.array([400, 200] + [1] * 30)).astype(np.int64)
    flat = rnd.integers(100, 104, size=(4000, 32))
    for cells, ended in ((steep, True), (flat, False)):
        own = block(cells)
        for q in range(0, 4000, 500):
            scores, rows = own.best(cells[q], q, 5)
            assert list(zip((-scores).tolist(), own.ids[rows].tolist(), strict=True)) == brute(cells, cells[q], q)
        assert (own.early > 0) == ended and (own.whole > 0) != ended


def test_small_blocks_of_many_units(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("CELLS", 24), ("QUERIES", 3), ("CHUNK", 2)):
        monkeypatch.setattr(topk, name, value)
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    cells = {i: [int(256 * x // 1) for x in v] for i, v in rows}
    got = defaultdict(list)
    for r in sorted(topk.top_k(frame, frame.where("vec_id < 20"), 3).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((-r["score"], r["vec_id"]))
    assert dict(got) == {q: sorted((-sum(a * b for a, b in zip(cells[q], v, strict=True)), i) for i, v in cells.items() if i != q)[:3] for q in range(20)}


def test_vectors_with_large_components_take_part(spark):
    rnd = random.Random(3)
    vectors = [(i, [rnd.uniform(-1, 1) * 10 ** rnd.choice(powers) for powers in ([0, 4, 7, 7], [0, 4], [0, 4])]) for i in range(1, 160)] + [(200, [2.0**23, 0.0, -0.001]), (250, [1.0, float("inf"), 0.0]), (251, [8388607.9] * 3)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    cells = {i: [int(256 * x // 1) for x in v] for i, v in vectors if i != 250}
    want = {}
    for q in cells:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(cells[q], v, strict=True)), i) for i, v in cells.items() if i != q)[:5]
            want[q] = [(-s, i) for s, i in best]
    got = defaultdict(list)
    for r in sorted(topk.top_k(frame, frame.where("vec_id % 50 = 0")).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["score"], r["vec_id"]))
    assert dict(got) == want and {i for x in want.values() for _, i in x if max(map(abs, cells[i])) >= 1 << 31}
    wide = spark.createDataFrame([(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [0.0, 1.0])], frame.schema)
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(wide, wide).collect()
    assert [tuple(r) for r in topk.top_k(wide.where("vec_id <> 0"), wide.where("vec_id = 2")).collect()] == [(2, 1, 1, 0)]


def test_known_sentences_are_normalised_and_anchored():
    for sentence in licenses.SENTENCES.values():
        assert sentence == re.sub("[^a-z0-9]+", " ", sentence).strip()
        assert any(a.split()[0] in sentence for a in licenses.ANCHORS)
    assert {i for _, _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES)


def test_licence_rules_need_their_order(spark):
    grant, source, binary = (licenses.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary"))
    texts = [
        None, "", "no licence here", "Released under the MIT License.", "x. LICENSED under the Apache-License, Version 2.0! y", f"{grant}: other. {source}; {binary}.", f"{binary}. {source}. {grant}.",
        "Released under the MIT License.\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License.", "permission " * 50000,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[3])], "doc_id long, text string").selectExpr("*", "1 as _names", "2 as licences")
    got = {r["doc_id"]: (r["n_known"], r["licences"], r["classes"]) for r in licenses.scan(docs).collect()}
    assert got == {0: (0, "", ""), 1: (0, "", ""), 2: (0, "", ""), 3: (1, "MIT", "permissive"), 4: (1, "Apache-2.0", "permissive"), 5: (3, "BSD-2-Clause", "permissive"), 6: (3, "", ""), 7: (3, "CC-BY-NC-4.0,MIT", "permissive,restricted"), 8: (0, "", ""), None: (1, "MIT", "permissive")}
    assert licenses.scan(docs.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Holder

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
"""
BSD3 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def licences_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["identifiers"], r["licences"]) for r in sorted(licenses.scan(docs).collect())]


def led(text, leader, end="\n"):
    return end.join(leader + line for line in text.split("\n"))


def test_wrapped_notices_are_recognised(spark):
    notices = {MIT: "MIT", BSD3: "BSD-2-Clause,BSD-3-Clause", ISC: "ISC", APACHE: "Apache-2.0", GPL3: "GPL-3.0"}
    for leader, end in (("", "\n"), (" * ", "\n"), ("# ", "\r\n"), ("// ", "\n"), (";; ", "\n"), ("rem ", "\n"), ("! ", "\n"), ("> ", "\r")):
        assert [got for _, got in licences_of(spark, [led(n, leader, end) for n in notices])] == list(notices.values()), leader
    assert licences_of(spark, [MIT])[0][0] == "mit-title-short mit-grant mit-notice as-is"
    items = BSD3.replace("1. ", "(a) ").replace("2. ", "2) ").replace("3. ", "* ")
    title = "A title\n" + ISC.rstrip()[:-1] + "\nanother line"
    apart = ["Released under\n\nthe MIT License", "Released under the.\nMIT License", "Released under\nthe MIT License too", "released\n#\nunder the MIT License"]
    got = licences_of(spark, [items, title, "Released under\n\tthe MIT License", *apart, "." * 100_000 + "licence"])
    assert got == [("bsd-grant bsd-source bsd-binary bsd-names", "BSD-2-Clause,BSD-3-Clause"), ("isc-grant", "ISC"), ("mit-ref", "MIT"), ("mit-title", ""), ("mit-title-short", ""), ("", ""), ("", ""), ("", "")]


GNU = """This {what} is free software; you can redistribute it and/or
modify it under the terms of the GNU {kind} Public
License as published by the Free Software Foundation{version}

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
{kind} Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_official_notices_are_recognised(spark):
    later, only = "{} either version {} of the License, or (at\nyour option) any later version.", "{} version {} of the License."
    versions = [("GPL-2.0", "program", "General", "2"), ("GPL-3.0", "program", "General", "3"), ("LGPL-2.0", "library", "Library General", "2"), ("LGPL-2.1", "library", "Lesser General", "2.1"), ("LGPL-3.0", "program", "Lesser General", "3"), ("AGPL-3.0", "program", "Affero General", "3")]
    cases = [(GNU.format(what=what, kind=kind, version=form.format(sign, v)), licence) for licence, what, kind, v in versions for form in (later, only) for sign in ";,"]
    cases += [(MPL, "MPL-2.0"), (MPL.replace("License, v. 2.0", "License, v.\n2.0"), "MPL-2.0"), (MPL.replace("v. 2.0", "v. 1.1"), "")]
    tags = "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC MPL-2.0 Unlicense CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 GPL-2.0 LGPL-2.1".split()
    cases += [(f"// SPDX-License-Identifier:{space}{x}", x) for x in tags for space in ("", " ", "  ")] + [("/* SPDX-License-Identifier: GPL-2.0+ */", "GPL-2.0")]
    cases += [(f"# SPDX-License-Identifier: {x}{end}\ncode", x) for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-1.0", "AGPL-3.0") for end in ("-only", "-or-later")]
    bodies = {"Apache License\n  Version 2.0, January 2004\nhttp://www.apache.org/licenses/": "Apache-2.0", "GNU GENERAL PUBLIC LICENSE\n  Version 2, June 1991": "GPL-2.0", "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007": "AGPL-3.0", "Mozilla Public License Version 2.0\n=====": "MPL-2.0", "Eclipse Public License - v 2.0": "EPL-2.0", "Boost Software License - Version 1.0 - August 17th, 2003": "BSL-1.0"}
    cases += list(bodies.items()) + [("This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:", "Zlib")]
    cases += [("SPDX-License-Identifier:\n\nMIT", ""), ("SPDX-License-Identifier: MIT-0", "")]
    one_line = [(re.sub(r"(?<!\n)\n(?!\n)", " ", t), x) for t, x in cases if not t.startswith(("#", "/", "S", "Apache", "Mozilla"))]
    assert [got for _, got in licences_of(spark, [t for t, _ in cases + one_line])] == [x for _, x in cases + one_line]


def test_url_lists_hold_at_fetch_time(spark):
    entries = spark.createDataFrame([("host", "a.b.example.com", "2024-01-10", True), ("host", "a.b.example.com", "2024-02-10", False), ("host", "a.b.example.com", "2024-02-10", False), ("host", "a.b.example.com", "2024-03-10", True), ("site", "b.example.com", "2024-06-01", True), ("prefix", "c.org/en", "2024-01-01", True), ("prefix", "c.org/en", "2024-01-01", False), (None, None, None, None)], "scope string, pattern string, at string, listed boolean").selectExpr("scope", "pattern", "cast(at as date) as at", "listed")
    cases = [("https://a.b.example.com/x", "2024-01-09", False), ("HTTPS://user@A.b.example.com:80/x", "2024-01-10", True), ("https://a.b.example.com/x", "2024-02-10", False), ("https://a.b.example.com/x", "2024-03-11", True), ("https://z.b.example.com", "2024-06-01", True), ("http://c.org/en/1", "2024-05-05", True), ("http://c.org/english", "2024-05-05", False), (None, "2024-05-05", False), ("not a url", "2024-05-05", False), ("http://c.org/en", None, False)]
    captures = spark.createDataFrame([(i, u, t) for i, (u, t, _) in enumerate(cases)], "page_id long, url string, fetched string").selectExpr("page_id", "url", "cast(fetched as date) as fetched", "1 as host", "2 as since")
    assert {r["page_id"]: r["blocked"] for r in url_filters.apply_lists(captures, entries).collect()} == {i: b for i, (_, _, b) in enumerate(cases)}
    assert not any(r["blocked"] for r in url_filters.apply_lists(captures, entries.limit(0)).collect())
    assert url_filters.apply_lists(captures.limit(0), entries).count() == 0


def test_url_lists_hold_for_subdomains_and_deep_paths(spark):
    listed = [("site", "foo.com", 10), ("site", "a.foo.com", 5), ("prefix", "foo.org/a/b", 10), ("prefix", "foo.org/a/c/", 10), ("prefix", "foo.org/q", 20), ("prefix", "foo.net/", 1), ("host", "com", 1), ("host", "bar.com", 1), ("site", "x.y.z.example.com", 3), ("host", "[2001:db8::7]", 2), (None, "foo.net", 1)]
    entries = spark.createDataFrame(listed, "scope string, pattern string, at int").selectExpr("*", "true as listed").unionByName(spark.createDataFrame([("site", "foo.com", 50, False)], "scope string, pattern string, at int, listed boolean"))
    cases = [
        ("http://foo.com/", 10, (None, 10, None)), ("http://www.foo.com/x", 10, (None, 10, None)), ("http://m.a.foo.com", 12, (None, 5, None)), ("http://m.a.foo.com", 60, (None, 5, None)), ("http://www.foo.com", 50, None), ("http://foo.com", 9, None), ("http://notfoo.com/", 12, None),
        ("http://foo.org/a/b", 10, (None, None, 10)), ("http://foo.org/A/b/c/d?x=/", 10, (None, None, 10)), ("http://foo.org/a/b/", 10, (None, None, 10)), ("http://foo.org/a/bc", 10, None), ("http://foo.org/a", 10, None), ("http://foo.org/a/c", 10, None), ("http://foo.org/a/c/", 10, (None, None, 10)), ("http://foo.org/a/c/d", 10, (None, None, 10)), ("http://foo.org?a/b", 10, None),
        ("http://www.foo.org/a/b", 10, None), ("http://foo.org/q/a/b", 30, (None, None, 20)), ("http://foo.net/", 2, (None, None, 1)), ("http://foo.net/a", 2, None), ("http://www.bar.com/", 2, None), ("http://bar.com/", 2, (1, None, None)), ("http://w.x.y.z.example.com", 3, (None, 3, None)), ("http://y.z.example.com", 3, None), ("http://[2001:db8::7]:8080/a", 4, (2, None, None)), ("http://u@[2001:db8::7]", 4, (2, None, None)), ("http://[2001:db8::8]/", 4, None), (None, 10, None), ("http://x" + "/" * 20_000, 10, None),
    ]
    captures = spark.createDataFrame([(i, u, t) for i, (u, t, _) in enumerate(cases)], "page_id long, url string, fetched int")
    captures = captures.unionByName(captures).unionByName(spark.createDataFrame([(None, "http://www.foo.com", 11)] * 3, captures.schema))
    want = [(i, *(since or (None, None, None)), since is not None) for i, (_, _, since) in enumerate(cases)] * 2 + [(None, None, 10, None, True)] * 3
    got = [(r["page_id"], r["host_since"], r["site_since"], r["prefix_since"], r["blocked"]) for r in url_filters.apply_lists(captures, entries).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


SCHEMA = {"add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": "string", "enum": ["x"]}}}}


def test_calls_are_linked_ordered_and_validated(spark):
    calls = [(1, "p", "add", '{"b":"x","a":1}', None), (1, "q", "add", '{"a":-1}', "p"), (1, "r", "add", "{", "q"), (1, "s", "add", '{"a":true,"c":1}', "gone"), (1, "t", "other", "{}", "s"), (1, "u", "add", '{"a":2}', "v"), (1, "v", "add", '{"a":2}', "u"), (1, "w", "add", '{"a":3}', "u"), (1, "p", "add", '{"b":"x","a":1}', None), (None, "p", "add", "{}", None), (2, "p", "add", None, "p")]
    results = [(1, "p", "é\n"), (1, "x", "lost"), (1, "q", None), (2, None, "no id")]
    got = {(r["conv"], r["call_id"]): r for r in chat.link_calls(spark.createDataFrame(calls, "conv long, call_id string, name string, arguments string, after string"), spark.createDataFrame(results, "conv long, call_id string, content string"), SCHEMA).collect()}
    assert {k: (r["status"], r["depth"], r["copies"]) for k, r in got.items()} == {
        (1, "p"): ("ok", 0, 2), (1, "q"): ("invalid", 1, 1), (1, "r"): ("invalid", 2, 1), (1, "s"): ("invalid", 0, 1), (1, "t"): ("invalid", 1, 1), (1, "u"): ("cycle", None, 1), (1, "v"): ("cycle", None, 1), (1, "w"): ("cycle", None, 1), (1, "x"): ("orphan_result", None, 0), (2, "p"): ("cycle", None, 1),
    }
    assert got[1, "p"]["json"] == '{"call":{"arguments":{"a":1,"b":"x"},"id":"p","name":"add"},"order":0,"result":{"content":"é\\n","id":"p"}}'
    assert got[1, "s"]["errors"] == "a: not integer; c: unknown"
    for r in got.values():
        assert chat.canonical(json.loads(r["json"])) == r["json"]


def test_differing_repeats_keep_rows_of_their_own(spark):
    calls = [(1, "p", "add", '{"a":1}', None), (1, "p", "add", '{"a":2}', None), (1, "p", "add", '{"a":2}', None), (1, "p", "add", None, None), (1, "q", "add", '{"a":1}', "p"), (2, "p", "add", '{"a":1}', None)]
    results = [(1, "p", "one"), (1, "p", "two"), (1, "p", "two"), (1, "p", None), (1, "x", "lost"), (1, "x", "lost"), (1, "x", "missed"), (1, "q", "three"), (1, "q", "three")]
    linked = chat.link_calls(spark.createDataFrame(calls, "conv long, call_id string, name string, arguments string, after string"), spark.createDataFrame(results, "conv long, call_id string, content string"), SCHEMA)
    got = Counter()
    for r in linked.collect():
        j = json.loads(r["json"])
        got[r["conv"], r["call_id"], r["depth"], r["status"], r["copies"], r["answers"], j["call"] and str(j["call"]["arguments"]), j["result"] and str(j["result"]["content"])] += 1
    assert got == Counter([
        (1, "p", 0, "invalid", 1, 1, "None", "None"), (1, "p", None, "repeated_call", 1, 0, "{'a': 1}", None), (1, "p", None, "repeated_call", 2, 0, "{'a': 2}", None),
        (1, "p", None, "repeated_result", 0, 1, None, "one"), (1, "p", None, "repeated_result", 0, 2, None, "two"), (1, "q", 1, "ok", 1, 2, "{'a': 1}", "three"),
        (1, "x", None, "orphan_result", 0, 2, None, "lost"), (1, "x", None, "repeated_result", 0, 1, None, "missed"), (2, "p", 0, "no_result", 1, 0, "{'a': 1}", None),
    ])


def test_odd_arguments_have_a_status(spark):
    odd = ['{"a":1e999}', '{"a":"\\ud800"}', '{"a":NaN}', "[" * 100_000, '{"a":' + "9" * 5000 + "}", '{"a":1.0}', '{"a":1e0}', '{"a":2.5}', "", "null", "[1]"]
    calls = spark.createDataFrame([(1, str(i), "add", a, None) for i, a in enumerate(odd)], "conv long, call_id string, name string, arguments string, after string").selectExpr("*", "'x' as status", "1 as depth", "'y' as json")
    got = {int(r["call_id"]): (r["status"], r["errors"], r["json"]) for r in chat.link_calls(calls, spark.createDataFrame([], "conv long, call_id string, content string"), SCHEMA).collect()}
    assert [got[i][:2] for i in range(5)] == [("invalid", "not JSON")] * 5 and json.loads(got[0][2])["call"]["arguments"] == odd[0]
    assert got[5][0] == got[6][0] == "no_result" and '"arguments":{"a":1}' in got[5][2] and '"arguments":{"a":1}' in got[6][2]
    assert got[7][:2] == ("invalid", "a: not integer") and [got[i][1] for i in (8, 9, 10)] == ["not an object"] * 3
    assert [chat.canonical(chat.parsed(x)) for x in ("-0.0", "1e2", "0.1", "1e22", '"é"')] == ["0", "100", "0.1", "1e+22", '"é"']


def test_turns_as_calls_equal_their_sql(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", None), (1, 2, "user", None), (1, 3, "assistant", None), (1, 4, "robot", "é\n" * 2000), (1, 5, "user", ""), (2, 1, "assistant", "early"), (2, 2, None, "x"), (None, 1, "user", "gone"), (3, None, "user", "gone"), (3, 7, "system", "one")]
    shape = "conv_id long, turn int, role string, text string"
    got = [tuple(r) for r in chat.link_calls(*chat.exchanges(spark.createDataFrame(turns, shape).selectExpr("*", "1 as conv", "'c' as call_id")), chat.REPLY).select("conv", "call_id", "depth", "copies", "status", "errors", "json").collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", turns)
    want = con.execute(f"SELECT conv, call_id, depth, copies, status, errors, json FROM ({oracles.CHAT})").fetchall()
    assert sorted(got, key=str) == sorted(want, key=str) and {r[4] for r in got} >= {"ok", "invalid", "no_result", "orphan_result"}


def test_depth_of_a_long_chain(spark):
    calls = spark.createDataFrame([(1, str(i), "add", '{"a":1}', str(i - 1) if i else None) for i in range(300)], "conv long, call_id string, name string, arguments string, after string")
    got = chat.link_calls(calls, spark.createDataFrame([], "conv long, call_id string, content string"), SCHEMA).collect()
    assert {r["call_id"]: r["depth"] for r in got} == {str(i): i for i in range(300)} and {r["status"] for r in got} == {"no_result"}
    assert chat.link_calls(calls.limit(0), spark.createDataFrame([], "conv long, call_id string, content string"), SCHEMA).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "packing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.materialize(stage(spark, now, SF), f"file://{tmp_path}/{name}")
        assert now.columns == docs.columns and now.count() <= before.count()
        if name == "line_dedup":
            report = {r["doc_id"]: r["kept_sha256"] for r in line_dedup.line_report(before).collect()}
            assert {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in now.collect()} == report and any(a["text"] != b["text"] for a, b in zip(before.orderBy("doc_id").collect(), now.orderBy("doc_id").collect(), strict=True))
        if name == "quality_rules":
            verdicts = {r["doc_id"]: r["kept"] for r in quality.quality_scores(docs).collect()}
            assert {r["doc_id"] for r in now.collect()} == {i for i, k in verdicts.items() if k}
        elif name == "jaccard_join":
            groups = brute_groups([(r["doc_id"], r["text"]) for r in before.collect()])
            assert {r["doc_id"] for r in now.collect()} == {c for _, c in groups.values()}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in now.collect()}
    last = max(r["sequence_id"] for r in packed)
    used = Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert all(n == packing.LENGTH for s, n in used.items() if s != last)


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null and repeated ids, extra columns with the stages' own names, and no documents at all."""
    words = [f"word{i}" for i in range(60)]
    text = " ".join(words)
    rows = [(None, text), (None, text + " tail"), (5, text), (5, text), (6, "short"), (None, None), (8, " ".join(words[::-1]) + "\n" + "this line is repeated in very many documents of all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as doc", "'b' as _doc", "'c' as _drops", "'d' as key", "'e' as row", "'f' as ids", "'g' as part")
    for name, frame in (("full", docs), ("empty", docs.limit(0))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        now = frame
        for step, stage in corpus_pipeline.STAGES[:-1]:
            now = corpus_pipeline.materialize(stage(spark, now, ""), f"file://{tmp_path}/{name}-{step}")
            assert now.columns == docs.columns
        got = Counter(r["doc_id"] for r in now.collect())
        assert got == (Counter({5: 1, 8: 1}) if name == "full" else Counter())
        assert {r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()} == set(got)


@pytest.mark.parametrize("most", [3, 1 << 18])
def test_scanned_units_find_all_links(monkeypatch, most):
    monkeypatch.setattr(jaccard, "SCANNED", most)
    rnd = np.random.default_rng(4)
    base = np.arange(1000, 1100)
    sets = [np.unique(np.concatenate([rnd.permutation(base)[: rnd.integers(78, 100)], rnd.integers(0, 1 << 40, rnd.integers(1, 16))])).astype("<u8") for _ in range(60)]
    rows = [(i, i % 3 > 0, s.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()) for i, s in enumerate(sets)]
    got = components.stars(*(c.to_numpy() for c in jaccard._scanned(rows).columns))
    links = [(i, j) for i in range(60) for j in range(60) if i != j and rows[i][1] and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
    want = components.stars(*(np.array(x) for x in zip(*links, strict=True)))
    assert len(links) > 40 and [x.tolist() for x in got] == [x.tolist() for x in want]
