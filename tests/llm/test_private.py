import hashlib
import itertools
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.helpers import SF, awkward, by_id, documents, empty

from tidewatt.llm import private as op
from tidewatt.llm.common import table

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def checksum(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == 2 and 16 <= len(digits) <= 19 and checksum(digits) or kind == 3 and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1 .@-+()52é", max_size=60))
def test_base_spans_are_the_patterns_matches(text):
    assert op.base_spans(text) == brute(text)


def test_cards_and_phones():
    text = "é 4111 1111 1111 1111, 4111111111111112 +49 30 1234567, +1 2. 300.1.1.1 and 1.2.3.4.5.6.7.8"
    assert op.base_spans(text) == brute(text)
    assert [k for k, _, _ in op.base_spans(text)] == [1, 1, 2, 3, 3]


def test_distant_repeats_are_labelled_alike():
    model = [op.np.log(op.np.full((op.BUCKETS, 5), 0.2)), op.np.zeros((op.BUCKETS, 5)), op.np.zeros((5, 5)),
             4 * op.np.eye(5) - 2]
    text = "call +1 (202) 555-0101 now. " + "word " * 500 + "again 202-555-0101 please, and 987-654-3210"
    base, every = op.all_spans(text, model)
    assert [text[s:e] for _, s, e in base] == ["+1 (202) 555-0101"]
    assert (3, text.index("202-555"), text.index("202-555") + 12) in every
    assert set(base) <= set(every)


def test_marginals_are_exact_on_trees():
    rng = op.np.random.default_rng(0)
    for edges in ([(0, 1), (1, 2), (2, 3)], [(0, 1), (0, 2), (0, 3)], [(0, 2)]):
        nodes, tables = rng.normal(size=(4, 3)), rng.normal(size=(len(edges), 3, 3))
        want = op.np.zeros((4, 3))
        for ys in itertools.product(range(3), repeat=4):
            total = sum(nodes[k, y] for k, y in enumerate(ys)) + sum(t[ys[a], ys[b]] for (a, b), t in zip(edges, tables, strict=True))
            for k, y in enumerate(ys):
                want[k, y] += op.np.exp(total)
        found = op.marginals(nodes, op.np.array(edges), tables)
        assert op.np.allclose(found, want / want.sum(1, keepdims=True), atol=0.01)


def test_pieces_that_fail_their_check():
    assert all(map(op.refused, ["4111111111111112", "300.100.100.100", "+49 30 12", "4111 1111 1111 1112"]))
    assert not any(map(op.refused, ["4111111111111111", "200.100.100.100", "+49 30 1234567", "49 30 1234567", "me [at] home.org"]))


def planted(times):
    """Numbers of one shape: phones repeated without their plus, and ten times as many that are something else."""
    texts, wanted = [], []
    for k in range(20 * times):
        number = f"49 30 {1000000 + 7919 * k}"
        texts.append(f"Call +{number} today. " + "word " * 60 + f"Or later {number} at home.")
        wanted.append((3, len(texts[-1]) - len(f"{number} at home."), len(texts[-1]) - len(" at home.")))
    for k in range(200 * times):
        texts.append(f"Order 17 82 {2000000 + 104729 * k % 7000000} was sent.")
        wanted.append(None)
    texts += [f"Card {4000000000000000 + 7 * k} was used." for k in range(60 * times)]  # one in ten passes Luhn
    return texts, wanted + [None] * 60 * times


def test_learned_factors_add_linked_numbers_only(spark):
    for times in (1, 5):
        texts, wanted = planted(times)
        model = op.learn(documents(spark, texts))
        for text, span in zip(texts, wanted, strict=True):
            base, every = op.all_spans(text, model)
            assert sorted(set(every) - set(base)) == ([span] if span else [])


def test_linked_ends_that_are_refused_tell_against_a_link(spark):
    """Where pieces that fail their check share digits with cards, the skip table learns it."""
    texts = [f"Card 4111 1111 1111 1111 and again {9000 + k} 1111 1111 1111 here." for k in range(300)]
    skip, start = op.learn(documents(spark, texts))[3], op.learn(empty(spark))[3]
    assert skip[2, 2] - skip[2, op.OTHER] < start[2, 2] - start[2, op.OTHER] - 3


def test_query_columns_and_awkward_rows(spark):
    docs = awkward(spark)
    found = op.private_spans(docs).collect()
    assert len(found) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        base = brute(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        listed = [f"{op.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(","))
    assert op.private_spans(empty(spark)).count() == 0


def test_whole_table_base_spans(spark):
    docs = table(spark, SF, "documents")
    found = by_id(op.private_spans(docs))
    for r in docs.collect():
        listed = ",".join(f"{op.KINDS[k]}:{s}:{e}" for k, s, e in brute(r.text))
        assert found[r.doc_id]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()


def test_masked_texts_hold_no_base_span(spark):
    docs = awkward(spark)
    after = op.masked(docs)
    assert after.columns == docs.columns
    rows = after.collect()
    assert not any(brute(r.text) for r in rows)
    mail = next(r for r in rows if r.doc_id == 9)
    assert mail.text == "mail <email> or <ip>, <phone>, <card>."
    assert mail.n_chars == len(mail.text)
    untouched = {repr(r) for r in docs.collect() if r.doc_id != 9}
    assert {repr(r) for r in rows if r.doc_id != 9} == untouched
    assert op.masked(documents(spark, [])).count() == 0
