import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tests.llm.helpers import awkward, awkward_texts, by_id, documents, empty, rows_of

from tidewatt.llm import periodic as op


def brute(words):
    """Stretches of every period by comparing all words, the smallest period of each."""
    found = {}
    for p in range(1, len(words) // 3 + 1):
        k = 0
        while k < len(words) - p:
            end = k
            while end < len(words) - p and words[end] == words[end + p]:
                end += 1
            if end > k and end - k + p >= max(24, 3 * p):
                found.setdefault((k, end - k + p), p)
            k = max(end, k + 1)
    return sorted((s, length, p) for (s, length), p in found.items())


def sequences(seed):
    rng = random.Random(seed)
    for _ in range(rng.randrange(1, 7)):
        n, letters = rng.choice([0, 1, 23, 24, 30, 100, 400]), rng.choice([1, 2, 3, 40])
        line = [rng.randrange(letters) for _ in range(n)]
        if n > 30:
            start, period = rng.randrange(n // 2), rng.randrange(1, 40)
            for k in range(start + period, min(n, start + period * rng.randrange(2, 9))):
                line[k] = line[k - period]
        yield np.array(line, np.int64)


@pytest.mark.parametrize("seed", range(60))
def test_runs_as_by_brute_force(seed):
    lines = list(sequences(seed))
    for line, found in zip(lines, op.sequence_runs(lines), strict=True):
        assert [tuple(map(int, row)) for row in found] == brute(line.tolist())


def test_extensions_of_any_two_positions():
    rng = np.random.default_rng(3)
    line = np.concatenate([rng.integers(0, 2, 150), np.zeros(90, np.int64), rng.integers(0, 2, 60), [-1]])
    index = op.Extensions(line)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(300), np.arange(300)))
    i, j = i[i != j], j[i != j]
    expected = [next(k for k in range(301) if line[a + k] != line[b + k]) for a, b in zip(i, j, strict=True)]
    assert index.agree(i, j).tolist() == expected


def test_the_cover_meets_every_pair():
    assert {(a - b) % op.MODULUS for a in op.COVER for b in op.COVER} == set(range(op.MODULUS))


def planted(doc_id, text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = brute(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        "doc_id": doc_id, "n_runs": len(runs), "start": best[0], "length": best[1], "period": best[2],
        "exponent_milli": None if best[0] is None else 1000 * best[1] // best[2],
        "runs_sha256": sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)),
        "collapsed_sha256": sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    }


def test_query_as_by_brute_force(spark):
    texts = [t if t is None or len(t) < 20_000 else "long " * 700 for t in awkward_texts()]
    rng = random.Random(5)
    texts += [" ".join(rng.choice(["ab", "A b", "ç", "d."]) for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += ["x  y\tz " * 40 + "x y z x", "one two three four five six seven eight " * 3]
    found = by_id(op.run_digests(op.with_repeats(documents(spark, texts))))
    assert any(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(len(texts)))
    for k, text in enumerate(texts):
        assert found[k] == expected(k, text)


def test_awkward_rows_keep_their_number(spark):
    frame = awkward(spark)
    found = rows_of(op.run_digests(op.with_repeats(frame)))
    assert len(found) == frame.count() and all(r["runs_sha256"] and r["collapsed_sha256"] for r in found)
    long = next(r for r in found if r["doc_id"] == 10)
    assert (long["n_runs"], long["length"], long["period"]) == (1, 30_000, 1)
    assert sum(r["doc_id"] is None for r in found) == 1 and sum(r["doc_id"] == 3 for r in found) == 2


def test_operator_gives_texts(spark):
    text = "start " + "again and again " * 12 + "end"
    row = rows_of(op.periodic_runs(documents(spark, [text])))[0]
    assert row["collapsed"] == "start again and again end"
    assert [(r["start"], r["length"], r["period"]) for r in row["runs"]] == [(1, 36, 3)]


def test_empty_table(spark):
    assert rows_of(op.run_digests(op.with_repeats(empty(spark)))) == []
