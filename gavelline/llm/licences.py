"""Licence scans by sentence rules: known sentences become identifiers, and sequences of identifiers become licences.

A text is a row of words (lower case, signs of comments and quotes and all punctuation but points between digits dropped,
spellings such as "licence" unified) in paragraphs, which end at blank lines and at lines of signs only.  A sentence may begin
and end at line ends, after a full stop, a question or an exclamation mark, a semicolon or a colon before white space, at the
ends of a web address and after a list number.  From each such place the longest known sentence that ends at another one is
taken, across all line ends, semicolons and colons inside, so wrapped texts count as unwrapped ones; a part that varies may
have any length.  The identifiers of a text in order, with nothing where a sentence is unknown (list numbers and bare web
addresses are no sentences), are matched against the rules in their order: a rule is a sequence of identifiers that follow one
another, each identifier counts for one licence only, so the fuller rules stand before their parts.
Known sentences that no rule takes are reported as such, not dropped.

The rows of a result are the licences found: doc_id, licence, rule, begin and end (characters in the text), in_order (its
number in the text) and sentences (the identifiers).

Defined results: null and empty texts have no licence and no row; repeated rows are scanned each; a null document id is
carried along; an empty table gives no rows.  Whole texts are scanned.
"""

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gavelline.llm import licence_table
from gavelline.llm.common import slices

RESULT = "doc_id long, licence string, rule string, begin long, end long, in_order long, sentences array<string>"

# Sentences by which public licences are granted, normalised, and the identifiers they stand for.
# {version} is a number with points, {holder} words (up to the next end of a sentence where it comes last), {year} one or
# more years, {id} an expression as it is written.  More sentences and rules are in licence_table.
SENTENCES = {
    "mit-name": ["released under the mit license", "licensed under the mit license", "the mit license",
                 "the mit license mit", "mit license", "this project is licensed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                  "associated documentation files the software to deal in the software without restriction including "
                  "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                  "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                  "the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the software"],
    "mit-warranty": ["the software is provided as is without warranty of any kind express or implied including but not "
                     "limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "apache-name": ["licensed under the apache license version {version}", "apache license version {version}",
                    "released under the apache license version {version}",
                    "licensed under the apache license version {version} the license"],
    "apache-use": ["you may not use this file except in compliance with the license"],
    "apache-copy": ["you may obtain a copy of the license at", "you may obtain a copy of the license at http www apache org "
                    "licenses license 2.0"],
    "apache-warranty": ["unless required by applicable law or agreed to in writing software distributed under the license "
                        "is distributed on an as is basis without warranties or conditions of any kind either express or "
                        "implied"],
    "gpl-name": ["this work is licensed under the gnu general public license version {version}",
                 "licensed under the gnu general public license version {version}",
                 "released under the gnu general public license version {version}",
                 "gnu general public license version {version}"],
    "gpl-grant": ["this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation either version {version} of the "
                  "license or at your option any later version"],
    "gpl-only": ["this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation version {version} of the license"],
    "lgpl-name": ["licensed under the gnu lesser general public license version {version}",
                  "this work is licensed under the gnu lesser general public license version {version}"],
    "agpl-name": ["licensed under the gnu affero general public license version {version}",
                  "this work is licensed under the gnu affero general public license version {version}"],
    "bsd-grant": ["redistribution and use in source and binary forms with or without modification are permitted provided "
                  "that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of conditions and the "
                   "following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                   "the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsd-endorse": ["neither the name of {holder} nor the names of its contributors may be used to endorse or promote "
                    "products derived from this software without specific prior written permission"],
    "bsd-name": ["licensed under the bsd license", "released under the bsd license", "licensed under the bsd 3 clause license",
                 "licensed under the bsd 2 clause license"],
    "cc-by-nc": ["licensed under cc by nc {version}", "this work is licensed under cc by nc {version}",
                 "this work is licensed under a creative commons attribution noncommercial {version} international license"],
    "cc-by-sa": ["licensed under cc by sa {version}", "this work is licensed under cc by sa {version}",
                 "this work is licensed under a creative commons attribution sharealike {version} international license"],
    "cc-by-nd": ["licensed under cc by nd {version}", "this work is licensed under cc by nd {version}"],
    "cc-by": ["licensed under cc by {version}", "this work is licensed under cc by {version}",
              "this work is licensed under a creative commons attribution {version} international license"],
    "cc0": ["licensed under cc0 {version}", "released under cc0 {version}", "cc0 {version} universal"],
    "mpl-name": ["licensed under the mozilla public license version {version}",
                 "this source code form is subject to the terms of the mozilla public license v {version}"],
    "copyright": ["copyright {year} {holder}", "copyright c {year} {holder}", "copyright {holder}"],
    "reserved": ["all rights reserved"],
}

# Rules in their order.  {version} is what the sentences gave.
RULES = [
    ("MIT", "mit-full", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("MIT", "mit-part", ["mit-grant"]),
    ("Apache-{version}", "apache-full", ["apache-name", "apache-use", "apache-copy", "apache-warranty"]),
    ("Apache-{version}", "apache-named", ["apache-name"]),
    ("BSD-3-Clause", "bsd-3-reserved", ["reserved", "bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-3-Clause", "bsd-3", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", "bsd-2-reserved", ["reserved", "bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD-2-Clause", "bsd-2", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-{version}-or-later", "gpl-later", ["gpl-grant"]),
    ("GPL-{version}-only", "gpl-only", ["gpl-only"]),
    ("GPL-{version}", "gpl-named", ["gpl-name"]),
    ("LGPL-{version}", "lgpl-named", ["lgpl-name"]),
    ("AGPL-{version}", "agpl-named", ["agpl-name"]),
    ("CC-BY-NC-{version}", "cc-by-nc", ["cc-by-nc"]),
    ("CC-BY-SA-{version}", "cc-by-sa", ["cc-by-sa"]),
    ("CC-BY-ND-{version}", "cc-by-nd", ["cc-by-nd"]),
    ("CC-BY-{version}", "cc-by", ["cc-by"]),
    ("CC0-{version}", "cc0", ["cc0"]),
    ("MPL-{version}", "mpl-named", ["mpl-name"]),
    ("BSD", "bsd-named", ["bsd-name"]),
    ("MIT", "mit-named", ["mit-name"]),
    ("Proprietary", "reserved", ["copyright", "reserved"]),
]

_TAKEN = {sentence for kinds in SENTENCES.values() for sentence in kinds}
for _name, _kinds in licence_table.named().items():
    if _new := [kind for kind in dict.fromkeys(_kinds) if kind not in _TAKEN]:
        SENTENCES[f"name {_name}"] = _new
        RULES.append((_name, "named", [f"name {_name}"]))
SENTENCES |= licence_table.GRANTS
RULES[:0] = licence_table.GRANT_RULES  # an identifier goes before all else, grants before names

_VERSION, _YEAR = re.compile(r"v?(\d+(?:\.\d+)*)"), re.compile(r"\d{4}")
_WORD = re.compile(r"(?:[^\W_]|(?<=\d)\.(?=\d))+")
_ADDRESS = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]*[^\s<>\"')\].,;:!?]", re.I)
_EDGE = re.compile(r"\n|[.!?;:](?=[\x20\x09-\x0D])")
_BREAK = re.compile(r"\n(?:(?:[^\w\n]|_)*\n)+")
_MARK = re.compile(r"(?:\d{1,3}(?:\.\d{1,3})*|[a-z]|[ivx]{1,5})[.)](?=\s|\Z)", re.I)
#: Signs of comments that are words.
_REMARK = re.compile(r"^[\x20\x09]*(rem|dnl|c)(?=\s)", re.I | re.M)
_REST = re.compile(r"[^\w\s]*")
#: Every known sentence has one of these, so a text without them has no known sentence.
_SIGNS = re.compile(
    r"licen[cs]e|copyright|copies|permi(?:ssion|tted)|warrant|redistribut|free[\W_]+software|cc0|rights[\W_]+reserved|public[\W_]+domain|cc[\W_]+by|creative[\W_]+commons|the[\W_]+mpl", re.I
)
_SAME = {"licence": "license", "licences": "licenses", "licenced": "licensed"}


def _compiled() -> dict[str, list]:
    """Known sentences by their first words: identifier and parts, which are lists of words or names of parts that vary."""
    found = {}
    for name, kinds in SENTENCES.items():
        for sentence in kinds:
            parts = [p if p[0] == "{" else p.split() for p in re.split(r"(\{\w+\})", sentence) if p.strip()]
            found.setdefault(parts[0][0], []).append((name, parts))
    return found


_KNOWN = _compiled()


class _Paragraph:
    """The words of a part of a text, where they lie, and between which of them a sentence may begin and end."""

    def __init__(self, text: str, begin: int, end: int):
        self.text = text
        addresses = [m.span() for m in _ADDRESS.finditer(text, begin, end)]
        signs = {m.start(1) for m in _REMARK.finditer(text, begin, end)}
        self.words, self.spans = [], []
        for m in _WORD.finditer(text, begin, end):
            word = m[0].lower()
            if m.start() in signs or (word == "c" and self.words and self.words[-1] == "copyright"):
                continue
            self.words.append(_SAME.get(word, word))
            self.spans.append(m.span())
        starts = [a for a, _ in self.spans]
        edges = {0, len(starts)} | {bisect_left(starts, m.start()) for m in _EDGE.finditer(text, begin, end)}
        self.bare = set()  # words of list numbers and web addresses
        for a, b in addresses:
            k, n = bisect_left(starts, a), bisect_left(starts, b)
            edges |= {k, n}
            self.bare.update(range(k, n))
        for k in sorted(edges):
            while k < len(starts) and k not in self.bare and _MARK.match(text, starts[k], end):
                self.bare.add(k)
                k += 1
                edges.add(k)
        self.edges, self.in_order, self.places = edges, sorted(edges), {}

    def after_holder(self, chunk: list[str], i: int) -> int | None:
        """The first place after i, and at least one word, where these words end a sentence."""
        key = tuple(chunk)
        if key not in self.places:
            n = len(chunk)
            heads = (k for k, word in enumerate(self.words) if word == chunk[0])
            self.places[key] = [k for k in heads if k + n in self.edges and self.words[k : k + n] == chunk]
        k = bisect_left(self.places[key], i + 1)
        return self.places[key][k] + len(chunk) if k < len(self.places[key]) else None

    def end_of(self, parts: list, i: int) -> tuple[int | None, str]:
        """Where a known sentence that begins at word i ends, if it is there, and its version."""
        words, version, k = self.words, "", 0
        while k < len(parts):
            part = parts[k]
            if part == "{version}":
                number = _VERSION.fullmatch(words[i]) if i < len(words) else None
                if not number:
                    return None, ""
                version, i = number[1], i + 1
            elif part == "{id}":  # an expression up to the end of its line, as it is written
                if i >= len(words):
                    return None, ""
                first, i = i, self.in_order[bisect_right(self.in_order, i)]
                version = self.text[self.spans[first][0] : _REST.match(self.text, self.spans[i - 1][1]).end()]
                version = re.sub(r"[^\w+)]+$", "", version.split("*/")[0].split("-->")[0])
            elif part == "{year}":
                first = i
                while i < len(words) and _YEAR.fullmatch(words[i]):
                    i += 1
                if i == first:
                    return None, ""
            elif part == "{holder}" and k + 1 < len(parts):
                k += 1  # the words behind the holder end the sentence
                i = self.after_holder(parts[k], i)
                if i is None:
                    return None, ""
            elif part == "{holder}":
                if i in self.edges:
                    return None, ""
                i = self.in_order[bisect_right(self.in_order, i)]
            else:
                if words[i : i + len(part)] != part:
                    return None, ""
                i += len(part)
            k += 1
        return (i, version) if i in self.edges else (None, "")

    def known_at(self, i: int) -> tuple[str, str, int] | None:
        """Identifier, version and end of the longest known sentence that begins at word i; of equal ones the first."""
        best = None
        for name, parts in _KNOWN.get(self.words[i], ()):
            end, version = self.end_of(parts, i)
            if end is not None and (best is None or end > best[2]):
                best = name, version, end
        return best

    def sentences(self):
        """Identifier and version or nothing, begin and end in the text, of all sentences."""
        i, n = 0, len(self.words)
        while i < n:
            if found := self.known_at(i):
                name, version, end = found
                yield (name, version), self.spans[i][0], self.spans[end - 1][1]
            else:
                end = self.in_order[bisect_right(self.in_order, i)]
                if not all(k in self.bare for k in range(i, end)):
                    yield None, self.spans[i][0], self.spans[end - 1][1]
            i = end


def known(sentence: str) -> tuple[str, str] | None:
    """Identifier and version, if any, of a sentence."""
    words = _Paragraph(sentence, 0, len(sentence))
    found = words.known_at(0) if words.words else None
    return found[:2] if found and found[2] == len(words.words) else None


def _paragraphs(text: str):
    begin = 0
    for m in _BREAK.finditer(text):
        yield begin, m.start()
        begin = m.end()
    yield begin, len(text)


def _sentences(text: str) -> list[tuple]:
    """The sentences of a text; unknown ones that follow one another are one."""
    found = []
    for begin, end in _paragraphs(text):
        signs = _SIGNS.search(text, begin, end)
        if not signs and (not found or not found[-1][0]):
            continue
        for sentence in _Paragraph(text, begin, end).sentences():
            if sentence[0] or not found or found[-1][0]:
                found.append(sentence)
    return found


def licences(text: str) -> list[tuple]:
    """licence, rule, begin, end, identifiers of a whole text, by place."""
    if not _SIGNS.search(text):
        return []
    tokens = [(t, begin, _REST.match(text, end).end()) for t, begin, end in _sentences(text)]
    names = [t[0][0] if t[0] else None for t in tokens]
    if not any(names):
        return []
    taken, found = [False] * len(names), []
    for licence, rule, sequence in RULES:
        for i in range(len(names) - len(sequence) + 1):
            if names[i : i + len(sequence)] == sequence and not any(taken[i : i + len(sequence)]):
                taken[i : i + len(sequence)] = [True] * len(sequence)  # None stands for a sentence that is not known
                version = next((t[0][1] for t in tokens[i : i + len(sequence)] if t[0] and t[0][1]), "")
                label = licence.replace("{version}", version) if version else licence.replace("-{version}", "")
                found.append((label, rule, tokens[i][1], tokens[i + len(sequence) - 1][2], [x for x in sequence if x]))
    for i, name in enumerate(names):
        if name and not taken[i]:
            found.append((None, "sentence without rule", tokens[i][1], tokens[i][2], [name]))
    return sorted(found, key=lambda f: f[2])


def scan(documents: DataFrame) -> DataFrame:
    """The licences of all documents (RESULT)."""

    def run(batches):
        names = [f.split()[0] for f in RESULT.split(", ")]
        types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for k, (licence, rule, begin, end, sentences) in enumerate(licences(text or "")):
                    out.append((doc_id, licence, rule, begin, end, k, sentences))
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)
