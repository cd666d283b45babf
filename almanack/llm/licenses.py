"""License scans by sentences and rules.

A text is read as words and sentence breaks. Each sentence that equals a known licence
sentence, after normalising case, punctuation and spacing, is mapped to its identifier
(``#`` in a known sentence stands for any number, as of a version, and ``*`` for one to twelve
words, as of a holder's name; in a document both are punctuation, as of a comment or heading). The
sequence of identifiers is then matched against ordered rules, the longest first; sentences farther apart than
``LARGEST_GAP`` characters (in the text of a GNU licence ``LARGEST_TEXT``) are not of one licence. The expression of an
SPDX line is a licence as it is written. British spellings count as American ones.

A sentence ends at a full stop, colon, semicolon, exclamation or question mark before white
space, and at an empty line; it may also begin or end at a line's start or end, and run over
lines. Null and empty texts have no licence. Rows are independent: repeated rows, ties
and null ids need no care. Only ``doc_id`` and ``text`` are read; no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .words import runs

# Sentences of well-known licences and notices, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-notice-3": "This project is licensed under the MIT License",
    "mit-title": "The MIT License",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    ' software and associated documentation files (the "Software"), to deal in the Software without'
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all"
    " copies or substantial portions of the Software",
    "mit-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR'
    " IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
    " PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache-notice": "Licensed under the Apache License, Version #",
    "apache-notice-2": 'Licensed under the Apache License, Version # (the "License")',
    "apache-title": "Apache License Version #, January 2004",
    "apache-use": "you may not use this file except in compliance with the License",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed"
    ' under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY'
    " KIND, either express or implied",
    "gpl-notice": "This work is licensed under the GNU General Public License, version #",
    "gpl-notice-2": "Licensed under the GNU General Public License, version #",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms"
    " of the GNU General Public License as published by the Free Software Foundation, either version #"
    " of the License, or (at your option) any later version",
    "gpl-grant-2": "you can redistribute it and/or modify it under the terms"
    " of the GNU General Public License as published by the Free Software Foundation, either version #"
    " of the License, or (at your option) any later version",
    "lgpl-notice": "Licensed under the GNU Lesser General Public License, version #",
    "agpl-notice": "Licensed under the GNU Affero General Public License, version #",
    "bsd-notice": "Licensed under the BSD License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials provided with"
    " the distribution",
    "bsd-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY'
    " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "bsd-endorse": "Neither the name of * nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    "bsd-endorse-2": "Neither the name of * nor the names of * contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission",
    "bsd-endorse-3": "The name of * may not be used to endorse or promote products derived from this software"
    " without specific prior written permission",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the"
    " following acknowledgement",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted, provided that the above copyright notice and this permission"
    " notice appear in all copies",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. #",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at"
    " https://mozilla.org/MPL/#/",
    "mpl-copy-2": "If a copy of the MPL was not distributed with this file, You can obtain one at"
    " http://mozilla.org/MPL/#/",
    "mpl-title": "Mozilla Public License Version #",
    "gnu-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but"
    " changing it is not allowed",
    "unlicense-grant": "This is free and unencumbered software released into the public domain",
    "cc-by-notice": "Licensed under CC BY #",
    "cc-by-sa-notice": "Licensed under CC BY-SA #",
    "cc-by-nc-notice": "Licensed under CC BY-NC #",
    "cc-by-nd-notice": "Licensed under CC BY-ND #",
    "cc-by-nc-sa-notice": "Licensed under CC BY-NC-SA #",
    "cc-by-nc-nd-notice": "Licensed under CC BY-NC-ND #",
    "cc-by-name": "This work is licensed under a Creative Commons Attribution # International License",
    "cc-by-sa-name": "This work is licensed under a Creative Commons Attribution-ShareAlike #"
    " International License",
    "cc0-notice": "This work is dedicated to the public domain under CC0 #",
}

# Name, titles and grants of further licences; a grant may end in other words (its first sentence).
_OTHERS = {
    "Zlib": (
        ("zlib License", "The zlib License", "zlib/libpng License"),
        ("Permission is granted to anyone to use this software for any purpose, including commercial applications,"
         " and to alter it and redistribute it freely, subject to the following restrictions",),
    ),
    "BSL-#": (
        ("Boost Software License - Version # - August 17th, 2003", "Distributed under the Boost Software License, Version #"),
        ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"
         " and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display,"
         " distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to"
         " permit third-parties to whom the Software is furnished to do so, all subject to the following",),
    ),
    "0BSD": (
        ("BSD Zero Clause License", "Zero-Clause BSD"),
        ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
         " hereby granted",),
    ),
    "WTFPL": (
        ("Do What The Fuck You Want To Public License",),
        ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and"
         " changing it is allowed as long as the name is changed",),
    ),
    "EPL-#": (
        ("Eclipse Public License - v #", "Eclipse Public License, Version #", "Eclipse Public License Version #"),
        ("This program and the accompanying materials are made available under the terms of the Eclipse Public"
         " License v#", "This program and the accompanying materials are made available under the terms of the Eclipse"
         " Public License # which is available at"),
    ),
    "Artistic-#": (("The Artistic License #", "Artistic License #"), ()),
    "OFL-#": (
        ("SIL Open Font License Version # - 26 February 2007", "SIL Open Font License, Version #"),
        ("This Font Software is licensed under the SIL Open Font License, Version #",),
    ),
    "CDDL-#": (
        ("Common Development and Distribution License (CDDL) Version #", "Common Development and Distribution License #"),
        ("The contents of this file are subject to the terms of the Common Development and Distribution License (the"
         " \"License\")",),
    ),
    "EUPL-#": (
        ("European Union Public Licence v. #", "European Union Public Licence, Version #"),
        ("Licensed under the EUPL, Version #", "Licensed under the EUPL v#"),
    ),
}

# Notices, grants, titles and first words of the GNU licences, by identifier.
_GNU = {
    "gpl": "General Public License",
    "lgpl": "Lesser General Public License",
    "lgpl-library": "Library General Public License",
    "agpl": "Affero General Public License",
}
_GNU_DATES = ("", ", 29 June 2007", ", 19 November 2007", ", February 1999", ", June 1991", ", February 1989")
_GNU_BODIES = {
    "gpl": ("The GNU General Public License is a free, copyleft license for software and other kinds of works",),
    "lgpl": ("This version of the GNU Lesser General Public License incorporates the terms and conditions of"
             " version # of the GNU General Public License, supplemented by the additional permissions listed below",),
    "agpl": ("The GNU Affero General Public License is a free, copyleft license for software and other kinds of"
             " works, specifically designed to ensure cooperation with the community in the case of network server"
             " software",),
}
_OLD_BODY = "The licenses for most software are designed to take away your freedom to share and change it"
_CC = {
    "by": ("Attribution",),
    "by-sa": ("Attribution-ShareAlike", "Attribution Share Alike"),
    "by-nc": ("Attribution-NonCommercial", "Attribution-Non-Commercial"),
    "by-nd": ("Attribution-NoDerivatives", "Attribution-NoDerivs", "Attribution-No Derivatives"),
    "by-nc-sa": ("Attribution-NonCommercial-ShareAlike", "Attribution-Non-Commercial-Share Alike"),
    "by-nc-nd": (
        "Attribution-NonCommercial-NoDerivatives",
        "Attribution-NonCommercial-NoDerivs",
        "Attribution-Non-Commercial-No Derivatives",
    ),
}
_HEADS = ("This work is licensed under", "Licensed under", "Released under")


def _families() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """Sentences and rules of the licences that differ by a few words."""
    sentences: dict[str, str] = {}
    rules: list[tuple[str, tuple[str, ...]]] = []

    def add(name: str, forms: list[str]) -> list[str]:
        found = {f"{name}-{i}": f for i, f in enumerate(dict.fromkeys(" ".join(f.split()) for f in forms))}
        sentences.update(found)
        return list(found)

    for kind, title in _GNU.items():
        licence, name = f"{kind.split('-')[0].upper()}-#", f"GNU {title}"
        terms = f"you can redistribute it and/or modify it under the terms of the {name}"
        by = " as published by the Free Software Foundation"
        subjects = [f"{s} is free software, " for s in ("This program", "This library", "This file", "This software", "It")]
        starts = [a + b + terms for a in ("", *subjects) for b in ("", "and ")]
        later = ["or (at your option) any later version", "or at your option any later version", "or any later version"]
        grants = add(f"{kind}-later", [f"{s}{by}, either version # of the License, {x}" for s in starts for x in later])
        only = [f"{s}{x}" for s in starts for x in (f" version #{by}", f", version #,{by}", f"{by}, version #",
                f"{by}, version # of the License", f"{by}, either version # of the License")]
        only = add(f"{kind}-only", only)
        heads = [f"{h} the {name}{v} #" for h in _HEADS for v in (", version", " v")]
        notices = add(f"{kind}-note", heads)
        titles = add(f"{kind}-full", [f"{name} Version #{d}" for d in _GNU_DATES])
        bodies = add(f"{kind}-body", [*_GNU_BODIES.get(kind, ()), _OLD_BODY] if kind == "gpl" else [*_GNU_BODIES.get(kind, ())])
        rules += [(f"{licence}-or-later", (g,)) for g in grants]
        rules += [(licence, (x,)) for x in (*only, *notices, *titles)]
        # The text of a licence ends with the grant that it proposes.
        ends = [g for g in (*grants, *(("gpl-grant", "gpl-grant-2") if kind == "gpl" else ()))]
        for t in titles:
            middles = [("gnu-verbatim",), *(("gnu-verbatim", b) for b in bodies)]
            if kind != "gpl":
                middles.append(("gnu-verbatim", "gpl-body-1"))
            rules += [(licence, (t, *m)) for m in middles]
            rules += [(licence, (t, *m, g)) for m in ((), *middles) for g in ends]
    for licence, (titles, grants) in _OTHERS.items():
        name = licence.removesuffix("-#").lower()
        heads = [f"{h} the {t}" for h in _HEADS for t in titles if not t.startswith(("The ", "Distributed"))]
        known = add(f"{name}-title", [*titles, *heads])
        given = add(f"{name}-grant", list(grants))
        rules += [(licence, (x,)) for x in (*known, *given)]
        rules += [(licence, (t, g)) for t in known for g in given]
    for kind, names in _CC.items():
        tails = ("International License", "Unported License", "Generic License", "License", "International", "")
        full = [f"{h} {a} Creative Commons {n} # {t}" for h in _HEADS for a in ("a", "the", "") for n in names for t in tails]
        short = [f"{h} {a} CC {kind} #" for h in _HEADS for a in ("", "a", "the")]
        rules += [(f"CC-{kind.upper()}-#", (x,)) for x in add(f"cc-{kind}", full + short)]
    return sentences, rules


_MORE_SENTENCES, _MORE_RULES = _families()
SENTENCES |= _MORE_SENTENCES

# A licence's name and the identifiers that establish it, in order.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-title", "mit-grant", "mit-condition", "mit-warranty")),
    ("MIT", ("mit-title-2", "mit-grant", "mit-condition", "mit-warranty")),
    *(("MIT", (t, *r)) for t in ("mit-title", "mit-title-2") for r in (("mit-grant", "mit-condition"), ("mit-grant",), ())),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-notice-3",)),
    ("Apache-#", ("apache-notice-2", "apache-use", "apache-copy", "apache-warranty")),
    ("Apache-#", ("apache-title", "apache-notice-2", "apache-use", "apache-copy", "apache-warranty")),
    ("Apache-#", ("apache-notice-2", "apache-use")),
    ("Apache-#", ("apache-notice-2",)),
    ("Apache-#", ("apache-notice",)),
    ("Apache-#", ("apache-title",)),
    ("GPL-#", ("gpl-notice",)),
    ("GPL-#", ("gpl-notice-2",)),
    ("GPL-#-or-later", ("gpl-grant",)),
    ("GPL-#-or-later", ("gpl-grant-2",)),
    ("LGPL-#", ("lgpl-notice",)),
    ("AGPL-#", ("agpl-notice",)),
    *(
        (name, ("bsd-grant", "bsd-source", "bsd-binary", *more, *end))
        for end in (("bsd-warranty",), ())
        for name, more in (
            *(("BSD-4-Clause", ("bsd-advertising", e)) for e in ("bsd-endorse", "bsd-endorse-2", "bsd-endorse-3")),
            *(("BSD-3-Clause", (e,)) for e in ("bsd-endorse", "bsd-endorse-2", "bsd-endorse-3")),
            ("BSD-2-Clause", ()),
        )
    ),
    ("BSD", ("bsd-notice",)),
    ("ISC", ("isc-grant",)),
    *(
        ("MPL-#", (*title, "mpl-notice", *copy))
        for title in (("mpl-title",), ())
        for copy in (("mpl-copy",), ("mpl-copy-2",), ())
    ),
    ("MPL-#", ("mpl-title",)),
    ("Unlicense", ("unlicense-grant",)),
    ("CC-BY-#", ("cc-by-notice",)),
    ("CC-BY-#", ("cc-by-name",)),
    ("CC-BY-SA-#", ("cc-by-sa-notice",)),
    ("CC-BY-SA-#", ("cc-by-sa-name",)),
    ("CC-BY-NC-#", ("cc-by-nc-notice",)),
    ("CC-BY-ND-#", ("cc-by-nd-notice",)),
    ("CC-BY-NC-SA-#", ("cc-by-nc-sa-notice",)),
    ("CC-BY-NC-ND-#", ("cc-by-nc-nd-notice",)),
    ("CC0-#", ("cc0-notice",)),
    ("#", ("spdx",)),
    *_MORE_RULES,
)
#: Every known sentence holds one of these; texts with none need no closer look.
#: They lie within a word, as lines may end between words.
MARKERS = re.compile(
    r"licen[sc]|permission|software|redistribut|copyright|domain|advertising|creative|mozilla|\bcc\b|eupl|bsd|materials|cddl"
)

_TOKEN = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*|\n|[.:;!?](?=\s|$)")
_PATTERN = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*|[#*]")
_LONGEST_NAME = 12  # words that a * stands for
_SPDX_ID = r"\(*[\w.+:-]+\)*"
_SPDX = re.compile(rf"(?i:spdx-license-identifier):[ \t]*({_SPDX_ID}(?:[ \t]+(?:AND|OR|WITH)[ \t]+{_SPDX_ID})*)")
_NUMBER = re.compile(r"[0-9]+(\.[0-9]+)*")


#: British spellings, which the known sentences are read with too.
_SPELLED = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense"}
#: Characters that may lie between two sentences of a rule; the text of a licence lies between a GNU title and its grant.
LARGEST_GAP, LARGEST_TEXT = 2_000, 60_000


def _words(text: str) -> tuple[list[tuple[str, int, int]], set[int]]:
    """Words with their places, and the numbers of words before which a sentence may break."""
    words, breaks = [], {0}
    for m in _TOKEN.finditer(text):
        if m[0][0].isalnum():
            words.append((_SPELLED.get(m[0], m[0]), m.start(), m.end()))
        else:
            breaks.add(len(words))
    return words, breaks | {len(words)}


def _known() -> dict[str, list[tuple[list[str], str]]]:
    """Sentences by their first word, the longest first."""
    out: dict[str, list[tuple[list[str], str]]] = {}
    for name, sentence in SENTENCES.items():
        low = sentence.lower()
        if not MARKERS.search(low):
            raise ValueError(f"sentence {name} has none of the markers")
        forms = [[]]
        for word in _PATTERN.findall(low):
            word = _SPELLED.get(word, word)
            lengths = range(1, _LONGEST_NAME + 1) if word == "*" else (1,)
            forms = [f + [word] * n for f in forms for n in lengths]
        for words in forms:
            out.setdefault(words[0], []).append((words, name))
    for sentences in out.values():
        sentences.sort(key=lambda s: -len(s[0]))
    return out


_KNOWN = _known()
_BY_FIRST: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
for _rule in sorted(RULES, key=lambda r: -len(r[1])):
    _BY_FIRST.setdefault(_rule[1][0], []).append(_rule)


def known_sentences(text: str) -> list[tuple[str, str, int, int]]:
    """(identifier, number it names, begin, end) of the known sentences, in order."""
    low = text.lower()
    if not MARKERS.search(low):
        return []
    if len(low) != len(text):  # letters whose lower case is longer would shift the places
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    words, breaks = _words(low)
    out, at = [], 0
    for m in _SPDX.finditer(text):
        named = m[1].rstrip(".:-")
        while named.endswith(")") and named.count(")") > named.count("("):
            named = named[:-1].rstrip(".:-")
        if named:
            out.append(("spdx", named, m.start(), m.start(1) + len(named)))
    while at < len(words):
        step = 1
        if at in breaks:
            for sentence, name in _KNOWN.get(words[at][0], ()):
                end = at + len(sentence)
                if end in breaks:
                    found = [w for w, _, _ in words[at:end]]
                    numbers = [w for w, k in zip(found, sentence, strict=True) if k == "#"]
                    same = all(w == k or k in "#*" for w, k in zip(found, sentence, strict=True))
                    if same and all(map(_NUMBER.fullmatch, numbers)):
                        out.append((name, "".join(numbers), words[at][1], words[end - 1][2]))
                        step = len(sentence)
                        break
        at += step
    return sorted(out, key=lambda s: s[2])


def licences(found: list[tuple[str, str, int, int]]) -> list[str]:
    """The licences that a sequence of sentences establishes, in order."""
    names, out, at = [s[0] for s in found], [], 0
    while at < len(names):
        for licence, rule in _BY_FIRST.get(names[at], ()):
            if tuple(names[at : at + len(rule)]) == rule and _adjacent(found[at : at + len(rule)]):
                number = next((s[1] for s in found[at : at + len(rule)] if s[1]), "")
                out.append(licence.replace("#", number) if number else licence.removesuffix("-#"))
                at += len(rule)
                break
        else:
            at += 1
    return out


def _adjacent(found: list[tuple[str, str, int, int]]) -> bool:
    """Whether no two sentences that follow each other are too far apart to be of one licence."""
    return all(
        b[2] - a[3] <= (LARGEST_TEXT if "gnu-verbatim" in (a[0], b[0]) or "-body-" in a[0] else LARGEST_GAP)
        for a, b in zip(found, found[1:])
    )


def scan_licences(docs: DataFrame) -> DataFrame:
    """A row for each document: its licences, and the sentences that were recognised."""
    names = ["doc_id", "licences", "sentences", "spans"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in runs(batch.column(1)):
                part = batch.slice(low, high - low)
                found = [known_sentences(t or "") for t in part.column(1).to_pylist()]
                columns = (
                    [licences(f) for f in found],
                    [[s[0] for s in f] for f in found],
                    [",".join(f"{s[0]}:{s[2]}:{s[3]}" for s in f) for f in found],
                )
                kinds = (pa.list_(pa.string()), pa.list_(pa.string()), pa.string())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=names)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, licences array<string>,"
    return docs.select("doc_id", "text").mapInArrow(
        work, schema + " sentences array<string>, spans string"
    )
