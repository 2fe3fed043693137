from tests.llm.helpers import SF, awkward, empty

from tidewatt.llm import licenses as op
from tidewatt.llm.common import table

MIT = """MIT License

Copyright (c) 2020 Somebody

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
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. And more.
"""
BSD = """Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met:
Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer.
Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or
other materials provided with the distribution."""
NAME = """
Neither the name of the copyright holder nor the names of its contributors may be used
to endorse or promote products derived from this software without specific prior written permission."""


def names(text):
    return [n for n, _, _ in op.licences(op.sentences(text))]


def test_rules_are_ordered_sequences():
    assert names(MIT) == ["MIT"]
    assert names(BSD) == ["BSD-2-Clause"]
    assert names(BSD + NAME) == ["BSD-3-Clause"]
    first, *others = BSD.split("\nRedistributions in")
    assert names(NAME + first) == []  # sentences of a rule in another order, or too few, are no licence


def test_narrow_columns():
    import textwrap

    body = " ".join(MIT.split("\n\n", 2)[2].split())
    for width in range(16, 121, 8):
        assert names("MIT License\n\n" + textwrap.fill(body, width)) == ["MIT"], width


def test_spans_and_spelling():
    text = "é intro.\nLicensed under the Apache  Licence,\nVersion 2.0.\nother words. All rights reserved."
    assert [(n, text[s:e]) for n, s, e in op.licences(op.sentences(text))] == [
        ("Apache-2.0", "Licensed under the Apache  Licence,\nVersion 2.0."), ("all-rights-reserved", "All rights reserved.")]
    assert names("Licensed under the Apache License, Version 2.0 and nothing else.") == []


def test_every_known_sentence_has_a_clue_and_every_identifier_a_rule():
    assert all(op.CLUE.search(s) for s in op.KNOWN)
    assert set(op.SENTENCES) == {name for _, rule in op.RULES for name in rule}


def brute(text):
    """Single-sentence rules by whole lines, which is how the tables hold them."""
    one = {rule[0]: licence for licence, rule in op.RULES if len(rule) == 1}
    lines = [op.normalised(line) for line in (text or "").split("\n")]
    return sorted({one[op.KNOWN[line]] for line in lines if line in op.KNOWN and op.KNOWN[line] in one})


def test_whole_table_against_lines(spark):
    docs = table(spark, SF, "documents")
    found = {r.doc_id: r.licences for r in op.licence_spans(docs).collect()}
    expected = {r.doc_id: ",".join(brute(r.text)) for r in docs.collect()}
    assert found == expected
    assert any(expected.values())


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    assert op.licence_spans(docs).filter("n_licences = 0 AND spans = ''").count() == docs.count()
    assert op.licence_spans(empty(spark)).count() == 0
