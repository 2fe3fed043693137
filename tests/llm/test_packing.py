import math
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import SF, awkward, documents, empty
from tokenizers import Tokenizer

from tidewatt.llm import packing as op
from tidewatt.llm.common import table
from tidewatt.llm.tokens import Encoder

FULL = Tokenizer.from_file(public_tokenizers.path(op.TOKENIZER))
ENCODER = Encoder(public_tokenizers.path(op.TOKENIZER))


def ids_of(text):
    return [*FULL.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from("— €語 '<|>")), max_size=80))
def test_quick_ids_are_the_tokenizers(text):
    assert ENCODER.ids(text).tolist() == ids_of(text)[:-1]


def check(docs, found):
    texts = sorted(((r.doc_id, ids_of(r.text)) for r in docs.collect()), key=repr)
    rows = found.collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for doc_id, ids in texts:
        mine = sorted(pieces[doc_id], key=lambda r: (r.piece, r.sequence_id))
        copies = sum(d == doc_id for d, _ in texts)
        assert len(mine) == copies * math.ceil(len(ids) / 1024)
        for r in mine:
            part = ids[r.start : r.start + r.length]
            assert len(part) == r.length and (r.length == 1024 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    return len(sequences), math.ceil(sum(r.length for r in rows) / 1024)


def test_pieces_and_places(spark):
    docs = table(spark, SF, "documents")
    used, least = check(docs, op.packed(docs))
    assert used <= least + 2


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    check(docs, op.packed(docs))
    assert op.packed(empty(spark)).count() == 0


def test_several_cells_and_levels(spark, monkeypatch):
    monkeypatch.setattr(op, "CELL", 40)
    rng = random.Random(1)
    docs = documents(spark, [" the" * rng.randint(0, 1500) for _ in range(300)])
    used, least = check(docs, op.packed(docs))
    assert used <= 1.04 * least + 2


def test_crossover_keeps_every_item_once():
    rng = random.Random(0)
    lengths = [rng.randint(1, 100) for _ in range(200)]
    island = op.Island(lengths, 100, 7)
    population = island.evolve(island.first())
    for bins in population:
        assert sorted(i for b in bins for i in b) == list(range(200))
        assert all(island.fill(b) <= 100 for b in bins)
    assert len(population[0]) <= len(op.best_fit(lengths, 100, [], island.order))
    numbers = op.numbered(population[0], 200)
    assert sorted(map(sorted, op.listed(numbers))) == sorted(map(sorted, population[0]))
