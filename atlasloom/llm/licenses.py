"""Licence scans by sentence rules, in DataFrame functions alone.

A text is cut into fragments at line ends and at . ! ? ; : before white space or the end; A-Z are
lower-cased and every run of other characters than a-z and 0-9 becomes one space. A known sentence is one
fragment, or several that single line ends divide: hard-wrapped paragraphs count as written on one line,
comment leaders (signs, `rem`, `dnl`) and list items' marks at the start of a line left out, while blank lines
and the signs above always end a sentence. Of known sentences that overlap the first counts, and of those that begin
together the shortest. Known sentences turn into identifiers, and a licence is recognised where the
identifiers of one of its rules occur in the rule's order (others may stand between).

The SQL knows CUT, SENTENCES and RULES alone: it gives the same for texts whose known sentences are among
these and stand on one line each. An SPDX tag counts if it names one licence; expressions (OR, AND, WITH) do not.

One pass over the scan without a shuffle or a join: the known sentences and the rules are a fixed table of
this module, carried in the plan. A text is cut only if it holds a word without which no known sentence
can occur. Null, empty and very long texts give their row like any other; ids are returned as they are,
null and repeated ones too; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and their usual notices, normalised; identifier first.
SENTENCES = {
    "mit-title": "the mit license",
    "mit-title-short": "mit license",
    "mit-ref": "released under the mit license",
    "mit-ref-licensed": "licensed under the mit license",
    "mit-spdx": "spdx license identifier mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache2-ref": "licensed under the apache license version 2 0",
    "apache2-ref-long": "licensed under the apache license version 2 0 the license",
    "apache2-spdx": "spdx license identifier apache 2 0",
    "apache2-use": "you may not use this file except in compliance with the license",
    "apache2-copy": "you may obtain a copy of the license at",
    "apache2-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-ref": "this work is licensed under the gnu general public license version 3",
    "gpl3-spdx": "spdx license identifier gpl 3 0 or later",
    "gpl3-spdx-only": "spdx license identifier gpl 3 0 only",
    "gpl2-spdx": "spdx license identifier gpl 2 0 only",
    "gpl3-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-grant": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-head": "this program is free software",
    "gpl3-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-received": "you should have received a copy of the gnu general public license along with this program",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2-ref": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccby4-ref": "licensed under cc by 4 0",
    "ccby4-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa4-ref": "licensed under cc by sa 4 0",
    "ccbysa4-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccbync4-ref": "licensed under cc by nc 4 0",
    "ccbync4-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
# Licence, class, identifiers in order.
RULES = [
    ("Apache-2.0", "permissive", ["apache2-ref"]),
    ("Apache-2.0", "permissive", ["apache2-spdx"]),
    ("Apache-2.0", "permissive", ["apache2-ref-long", "apache2-use"]),
    ("Apache-2.0", "permissive", ["apache2-use", "apache2-copy", "apache2-basis"]),
    ("BSD-2-Clause", "permissive", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-3-Clause", "permissive", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("CC-BY-4.0", "permissive", ["ccby4-ref"]),
    ("CC-BY-4.0", "permissive", ["ccby4-work"]),
    ("CC-BY-NC-4.0", "restricted", ["ccbync4-ref"]),
    ("CC-BY-NC-4.0", "restricted", ["ccbync4-work"]),
    ("CC-BY-SA-4.0", "copyleft", ["ccbysa4-ref"]),
    ("CC-BY-SA-4.0", "copyleft", ["ccbysa4-work"]),
    ("GPL-2.0", "copyleft", ["gpl2-spdx"]),
    ("GPL-2.0", "copyleft", ["gpl2-grant", "gpl-hope"]),
    ("GPL-3.0", "copyleft", ["gpl3-ref"]),
    ("GPL-3.0", "copyleft", ["gpl3-spdx"]),
    ("GPL-3.0", "copyleft", ["gpl3-spdx-only"]),
    ("GPL-3.0", "copyleft", ["gpl3-grant", "gpl-hope"]),
    ("GPL-3.0", "copyleft", ["gpl-head", "gpl3-terms", "gpl-hope"]),
    ("ISC", "permissive", ["isc-grant"]),
    ("MIT", "permissive", ["mit-ref"]),
    ("MIT", "permissive", ["mit-ref-licensed"]),
    ("MIT", "permissive", ["mit-spdx"]),
    ("MIT", "permissive", ["mit-title", "mit-grant"]),
    ("MIT", "permissive", ["mit-title-short", "mit-grant"]),
    ("MIT", "permissive", ["mit-grant", "mit-notice", "as-is"]),
    ("MPL-2.0", "copyleft", ["mpl2-ref"]),
    ("Unlicense", "permissive", ["unlicense"]),
]
_TERMS = "you can redistribute it and or modify it under the terms of the gnu {} public license as published by the free software foundation | "
_LATER, _ONLY = "either version {} of the license or at your option any later version", "version {} of the license"
# Identifier, licence, public licence of GNU, version.
_GNU = [
    ("gpl2", "GPL-2.0", "general", "2"), ("gpl3", "GPL-3.0", "general", "3"), ("lgpl2", "LGPL-2.0", "library general", "2"),
    ("lgpl21", "LGPL-2.1", "lesser general", "2 1"), ("lgpl3", "LGPL-3.0", "lesser general", "3"), ("agpl3", "AGPL-3.0", "affero general", "3"),
]
# Licence, class, SPDX names.
_SPDX = [
    ("Apache-2.0", "permissive", ["apache 2 0"]),
    ("BSD-2-Clause", "permissive", ["bsd 2 clause"]),
    ("BSD-3-Clause", "permissive", ["bsd 3 clause"]),
    ("CC-BY-4.0", "permissive", ["cc by 4 0"]),
    ("CC-BY-NC-4.0", "restricted", ["cc by nc 4 0"]),
    ("CC-BY-SA-4.0", "copyleft", ["cc by sa 4 0"]),
    ("ISC", "permissive", ["isc"]),
    ("MIT", "permissive", ["mit"]),
    ("MPL-2.0", "copyleft", ["mpl 2 0", "mpl 2 0 no copyleft exception"]),
    ("Unlicense", "permissive", ["unlicense"]),
    ("0BSD", "permissive", ["0bsd"]),
    ("BSL-1.0", "permissive", ["bsl 1 0"]),
    ("CC0-1.0", "permissive", ["cc0 1 0"]),
    ("EPL-2.0", "copyleft", ["epl 2 0"]),
    ("Zlib", "permissive", ["zlib"]),
    *((x, "copyleft", [x.lower().replace("-", " ").replace(".", " ") + end for end in ("", " only", " or later")]) for x in ("GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-1.0", "AGPL-3.0")),
]
_SPDX_NAMES = {sentence: name for name, sentence in SENTENCES.items() if "-spdx" in name}


def _spdx(name: str) -> str:
    return _SPDX_NAMES.get(f"spdx license identifier {name}", "spdx-" + name.replace(" ", "-"))


# Identifier, licence, class, and the title or opening sentences that the licences' own texts have, normalised.
_BODIES = [
    ("apache2-body", "Apache-2.0", "permissive", ["apache license version 2 0 january 2004"]),
    ("gpl2-body", "GPL-2.0", "copyleft", ["gnu general public license version 2 june 1991"]),
    ("gpl3-body", "GPL-3.0", "copyleft", ["gnu general public license version 3 29 june 2007"]),
    ("lgpl21-body", "LGPL-2.1", "copyleft", ["gnu lesser general public license version 2 1 february 1999"]),
    ("lgpl3-body", "LGPL-3.0", "copyleft", ["gnu lesser general public license version 3 29 june 2007"]),
    ("agpl3-body", "AGPL-3.0", "copyleft", ["gnu affero general public license version 3 19 november 2007"]),
    ("mpl2-body", "MPL-2.0", "copyleft", ["mozilla public license version 2 0"]),
    ("epl2-body", "EPL-2.0", "copyleft", ["eclipse public license v 2 0"]),
    ("bsl1-body", "BSL-1.0", "permissive", ["boost software license version 1 0 august 17th 2003"]),
    ("zlib-body", "Zlib", "permissive", ["this software is provided as is without any express or implied warranty", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"]),
    ("cc0-ref", "CC0-1.0", "permissive", ["licensed under cc0 1 0"]),
]


#: Further known sentences, and forms of the above, as official notices have them; | is where a sign may end a fragment.
NOTICES = {
    "mpl2-ref": "this source code form is subject to the terms of the mozilla public license v | 2 0",
    "lgpl-head": "this library is free software",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty",
    **{f"{i}-terms": _TERMS.format(kind) + _LATER.format(v) for i, _, kind, v in _GNU},
    **{f"{i}-terms-only": _TERMS.format(kind) + _ONLY.format(v) for i, _, kind, v in _GNU},
    **{f"{i}-{k}": s for i, _, _, sentences in _BODIES for k, s in enumerate(sentences)},
    **{_spdx(name): f"spdx license identifier | {name}" for _, _, names in _SPDX for name in names},
}
KNOWN = SENTENCES | NOTICES
ALL_RULES = [
    *RULES,
    *((licence, "copyleft", [f"{head}-head", i + terms, f"{head}-hope"]) for i, licence, _, _ in _GNU for terms in ("-terms", "-terms-only") for head in ("gpl", "lgpl")),
    *((licence, kind, [f"{i}-{k}" for k in range(len(sentences))]) for i, licence, kind, sentences in _BODIES),
    *((licence, kind, [_spdx(name)]) for licence, kind, names in _SPDX for name in names),
]
#: Every known sentence holds one of these; a text without them is not cut.
ANCHORS = ["licen", "permission", "warrant", "redistribut", "free software", "free and unencumbered"]
CUT = r"[.!?;:]+([\x20\x09-\x0D]|$)|[\x0A-\x0D]"
#: What starts a line without belonging to its sentence, ends of sentences, and line ends; the latter two become X and N, which no lower-cased text holds.
LEADER = r"(?<![^\x0A-\x0D])[^a-z0-9\x0A-\x0D]*(?:(?:rem|dnl)[\x20\x09]+|(?:[0-9]{1,3}|[a-z]|[ivx]{1,5})\)[^a-z0-9\x0A-\x0D]*)?"
STOP = r"(?<![.!?;:])[.!?;:]++(?=[\x20\x09-\x0D]|\z)"
LINE_END = r"\x0D\x0A|[\x0A-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def anchored(sentence: str) -> bool:
    """Whether a sentence that normalises to this one must hold an anchor: words of an anchor may be apart in the raw text."""
    return any(a in sentence for a in ANCHORS if " " not in a) or any(re.search(r"\b" + a.split()[0] + r"\b", sentence) for a in ANCHORS if " " in a)


def _words_of_anchor(text: Column) -> Column:
    low = F.lower(text)
    found = F.lit(False)
    for a in dict.fromkeys(a.split()[0] if " " in a else a for a in ANCHORS):
        found = found | F.contains(low, F.lit(a))
    return found


def _pattern() -> str:
    """Any known sentence as a whole number of fragments, the shortest first."""
    forms = (s.replace(" | ", "#").replace(" ", "[ N]").replace("#", "(?:XN?|[ N])") for s in sorted(KNOWN.values(), key=len))
    return "(?<![^XN])(?:" + "|".join(forms) + ")(?![^XN])"


def _marked(text: Column) -> Column:
    """The text's words with one space, or X or N, between two; N N (a blank line) stays two marks."""
    text = F.regexp_replace(F.translate(text, UPPER, LOWER), LEADER, "")
    text = F.regexp_replace(F.regexp_replace(text, STOP, "X"), LINE_END, "N")
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z0-9XN]+", " "), " ?([XN]) ?", "$1"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_known (known sentences), identifiers (in order, by spaces), licences and classes (sorted, by commas; empty if none)."""
    known = F.create_map(*[F.lit(x) for name, sentence in KNOWN.items() for x in (sentence.replace(" | ", " "), name)])
    text = docs[text_col].cast("string")
    found = F.regexp_extract_all(_marked(text), F.lit(_pattern()), F.lit(0))
    names = F.transform(found, lambda s: F.element_at(known, F.regexp_replace(s, "[XN]+", " ")))
    none = F.array().cast("array<string>")
    rows = docs.select(docs[id_col].alias("_id"), F.when(_words_of_anchor(text), F.array_compact(names)).otherwise(none).alias("_names"))
    rows = rows.select("_id", F.coalesce("_names", none).alias("_names"))
    line = F.concat(F.lit("<"), F.array_join("_names", "><"), F.lit(">"))

    def matched(pick: int) -> Column:
        hits = [F.when(line.like("%" + "%".join(f"<{i}>" for i in ids) + "%"), F.lit((licence, kind)[pick])) for licence, kind, ids in ALL_RULES]
        found = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))), ",")
        return F.when(F.size("_names") == 0, "").otherwise(found)

    return rows.select(F.col("_id").alias(id_col), F.size("_names").cast("long").alias("n_known"), F.array_join("_names", " ").alias("identifiers"), matched(0).alias("licences"), matched(1).alias("classes"))
