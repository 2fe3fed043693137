import hashlib
import random
import re

import pytest
from tests.llm.helpers import awkward, by_id, documents, empty, rows_of

from tidewatt.llm import automaton
from tidewatt.llm import secrets as op
from tidewatt.llm.common import table

PATTERNS = [(k, rule, re.compile(f"{rule.head}({rule.body})"), re.compile(rule.head)) for k, rule in enumerate(op.RULES)]
PIECES = [
    "token", "=", " ", '"', "'", "secret:", "api_key", "API-KEY", "abcdefgh1", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "ghp_",
    "a" * 36, "xoxb-", "123456789012", "eyJ", ".", "eyJabc", "://u:", "p@ss", "@h", "bearer ", "-----BEGIN ", "RSA ",
    "PRIVATE KEY-----", "-----END ", "é", "\n", "Password", "passwd", "x", "ſecret",
]


def brute(text):
    """Every rule by itself, with the regular expressions of the standard library."""
    found = []
    for place, rule, pattern, head in PATTERNS:
        for m in pattern.finditer(text or ""):
            if len(m[0]) - head.match(m[0]).end() >= rule.least:
                found.append((m.start(), m.end(), place))
    return sorted(found, key=lambda span: (span[0], span[2]))


@pytest.mark.parametrize("seed", range(20))
def test_all_rules_at_once_find_what_each_finds(seed):
    scan, rng = SCAN, random.Random(seed)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(16)))
        assert op.spans(scan, text.encode()) == brute(text)


SCAN = op.scanner()


def test_automaton_is_the_smallest(spark):
    """No two states of it are told apart by nothing, and all are reached."""
    made = automaton.compiled(["(ab|cb)+", "a[bc]{2,3}", "c*d"], anywhere=True)
    states = range(0, len(made.table), made.width)
    follow = lambda s, kinds: s if not kinds else follow(made.table[s + kinds[0]], kinds[1:])
    words = [[]]
    for _ in range(5):
        words += [[*w, k] for w in words for k in range(made.width) if len(w) < 5]
    tries = {tuple(w) for w in words}
    seen = {tuple(made.accepts.get(follow(s, w), frozenset()) for w in sorted(tries)) for s in states}
    assert len(seen) == len(states)
    assert {0} | {follow(0, w) for w in tries} == set(states)


@pytest.mark.parametrize("pattern", ["a{2}", "a{2,}", "a{1,3}", "(a|bc)*d", r"\.[a-c_-]+", "x?y?z", "(ab?)+c"])
def test_expressions(pattern):
    made, peer = automaton.compiled([pattern], anywhere=False), re.compile(pattern)
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice("abcdxyz._-") for _ in range(rng.randrange(8)))
        whole = [e for e in range(1, len(text) + 1) if peer.fullmatch(text, 0, e)]
        assert automaton.longest(made, text.encode().translate(made.classes), 0) == max(whole, default=-1)


def test_a_failing_match_takes_its_text(spark):
    text = "token=secret:abcdefgh12 token=secret;secret:abcdefgh12"
    assert [(text[s:e], k) for s, e, k in op.spans(SCAN, text.encode())] == [("secret:abcdefgh12", 0)]


def test_digests_as_by_brute_force(spark):
    texts = [None, "", "é token = '0123456789abcdef0123456789abcdef' ü", "AKIA" + "Z9" * 6, "AKIA" + "Z9" * 5 + "Z",
             "key ghp_" + "a1B" * 12 + " xoxb-1234567890-ab", "https://user:pass@host.example/x", "long " * 40_000 + "token:abcdefgh"]
    found = by_id(op.secret_digests(documents(spark, texts)))
    for k, text in enumerate(texts):
        name = lambda s: f"{op.RULES[s[2]].kind}:{s[0]}:{s[1]}"
        every = brute(text)
        base = [s for s in every if s[2] < 3]
        assert found[k]["spans"] == ",".join(map(name, every))
        assert found[k]["base_sha256"] == hashlib.sha256(",".join(map(name, base)).encode()).hexdigest()
        assert [found[k][f"n_{r.kind}"] for r in op.BASE] == [sum(s[2] == j for s in base) for j in range(3)]
        assert found[k]["n_added"] == len(every) - len(base)


def test_added_spans_leave_prose_alone(spark):
    found = op.secret_digests(table(spark, "/root/testdata/sf0.01", "documents"))
    assert found.filter("n_assign > 0").count() and not found.filter("n_added > 0").count()


def test_redacted_texts(spark):
    texts = ["my é token=abcdefgh and " + "0f" * 16 + "!", "nothing", None, ""]
    found = by_id(op.redacted(documents(spark, texts, clashes=["found", "spans"])))
    assert [found[k]["text"] for k in range(4)] == ["my é <assign> and <hex>!", "nothing", None, ""]
    assert found[0]["n_chars"] == len(found[0]["text"]) and found[2]["n_chars"] is None
    assert found[0]["found"] == "extra found"


def test_awkward_rows(spark):
    frame = awkward(spark)
    assert op.secret_digests(frame).count() == frame.count()
    assert rows_of(op.secret_digests(empty(spark))) == [] and rows_of(op.redacted(empty(spark))) == []
