"""Licence scans by sentence rules.

A text is cut into pieces at line ends and after sentence ends.  A sentence is a
piece, or a run of pieces that line ends have cut (the longest run that is
known).  Normalised (lower case, one spelling of licence, words only), it is
looked up among known sentences and gives an identifier.  Rules are ordered
sequences of identifiers; a rule is met by sentences in that order, each at most
``GAP`` pieces after the one before.  Longer rules go first, and a sentence
counts for one rule only.

Defined results: a null, empty or other text without known sentences has no
licence: empty lists and counts of 0.  Repeated rows each get a row.  Offsets
count code points, ends are exclusive.  Every text is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatt.llm.common import slices

GAP = 3
WORD = re.compile(r"[a-z0-9]+")
PIECE = re.compile(r"[^\n]+?(?:(?<=[.!?:;])(?=\s)|(?=\n)|\Z)")

# Sentences of public licence texts and notices, by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the License)",
        "This work is licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0",
    ),
    "apache-2.0-use": ("you may not use this file except in compliance with the License",),
    "apache-2.0-copy": ("You may obtain a copy of the License at",),
    "apache-2.0-basis": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        "on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "mit-notice": (
        "Released under the MIT License", "Licensed under the MIT License", "This work is licensed under the MIT License",
        "The MIT License", "MIT License", "The MIT License (MIT)", "SPDX-License-Identifier: MIT",
    ),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    "mit-keep": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software",
    ),
    "mit-as-is": (
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer",
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution",
    ),
    "bsd-name": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission",
    ),
    "bsd-2-notice": ("SPDX-License-Identifier: BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    "bsd-3-notice": ("SPDX-License-Identifier: BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    "gpl-3-notice": (
        "This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only",
        "Licensed under the GNU General Public License, version 3", "GNU GENERAL PUBLIC LICENSE Version 3",
    ),
    "gpl-2-notice": (
        "This work is licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only",
        "Licensed under the GNU General Public License, version 2", "GNU GENERAL PUBLIC LICENSE Version 2",
    ),
    "gpl-free": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version",
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "cc0": ("SPDX-License-Identifier: CC0-1.0", "Licensed under CC0 1.0"),
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "rights": ("All rights reserved",),
}
# Licences by the sentences they consist of, in order.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("apache-2.0-notice", "apache-2.0-use", "apache-2.0-copy", "apache-2.0-basis")),
    ("Apache-2.0", ("apache-2.0-notice",)),
    ("MIT", ("mit-notice", "mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", ("mit-notice",)),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-2-notice",)),
    ("BSD-3-Clause", ("bsd-3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-only", ("gpl-3-notice",)),
    ("GPL-2.0-only", ("gpl-2-notice",)),
    ("CC-BY-4.0", ("cc-by-4.0",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0",)),
    ("CC0-1.0", ("cc0",)),
    ("MPL-2.0", ("mpl-2",)),
    ("Unlicense", ("unlicense",)),
    ("ISC", ("isc-grant",)),
    ("all-rights-reserved", ("rights",)),
)
Sentence = tuple[str, int, int, int, int]  # identifier, start, end, first piece, last piece


def normalised(text: str) -> str:
    return " ".join(WORD.findall(text.lower().replace("licence", "license")))


def known_sentences() -> dict[str, str]:
    return {normalised(text): name for name, texts in SENTENCES.items() for text in texts}


KNOWN = known_sentences()
# Every known sentence holds one of these; a text without any is not cut into pieces.
CLUE = re.compile("licen[cs]e|spdx|reserved|software|permission|redistribut|warrant|copyright", re.I)
PREFIXES = {" ".join(sentence.split()[:k]) for sentence in KNOWN for k in range(1, len(sentence.split()) + 1)}


def sentences(text: str) -> list[Sentence]:
    """Known sentences in order."""
    pieces = [(m.start(), m.end()) for m in PIECE.finditer(text)]
    found, k = [], 0
    while k < len(pieces):
        best, joined = None, ""
        for j in range(k, len(pieces)):
            start, end = pieces[j]
            joined = f"{joined} {normalised(text[start:end])}".strip()
            if joined not in PREFIXES:  # so a sentence ends where no known one goes on, however it is wrapped
                break
            if joined in KNOWN:
                best = (KNOWN[joined], pieces[k][0], end, k, j)
        if best:
            name, start, end, first, last = best
            cut = len(text[start:end]) - len(text[start:end].lstrip())
            found.append((name, start + cut, end, first, last))
        k = best[4] + 1 if best else k + 1
    return found


def licences(found: list[Sentence]) -> list[tuple[str, int, int]]:
    """(licence, start, end) in order of start."""
    free, out = set(range(len(found))), []
    for licence, rule in sorted(RULES, key=lambda r: -len(r[1])):
        for first in range(len(found)):
            met: list[int] = []
            for k in range(first, len(found)):
                if k in free and found[k][0] == rule[len(met)] and (not met or found[k][3] - found[met[-1]][4] <= GAP):
                    met.append(k)
                    if len(met) == len(rule):
                        break
                elif not met:
                    break
                elif found[k][3] - found[met[-1]][4] > GAP:
                    break
            if len(met) == len(rule):
                free -= set(met)
                out.append((licence, found[met[0]][1], found[met[-1]][2]))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def licence_spans(documents: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), n_licences, licences (sorted names), spans, identifiers, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                found = sentences(text) if text and CLUE.search(text) else []
                spans = licences(found)
                rows.append((
                    len(found), len(spans), ",".join(sorted({s[0] for s in spans})),
                    ",".join(f"{name}:{start}:{end}" for name, start, end in spans), ",".join(s[0] for s in found),
                ))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]],
                names=["doc_id", "n_sentences", "n_licences", "licences", "spans", "identifiers"])

    schema = "doc_id bigint, n_sentences bigint, n_licences bigint, licences string, spans string, identifiers string"
    return documents.select("doc_id", "text").mapInArrow(run, schema)
