import hashlib

import pytest
from tests.llm.helpers import awkward, by_id, documents, empty, words

from tidewatt.llm import decontamination as op

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then sleeps"), (2, "short item"), (3, None), (4, ""),
         (5, "É ünï 12"), (10, "short ITEM!"), (7, "one two three four five six seven eight nine ten")]


def brute(text, items, size=10):
    w, hit, found = words(text, PATTERN), set(), set()
    for item, item_text in items:
        v = words(item_text, PATTERN)
        n = min(size, len(v))
        for k in range(max(len(v) - size + 1, 1) if v else 0):
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[k : k + n]:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit)


TEXTS = ["x THE QUICK-brown fox jumps over the lazy dog and then sleeps. short item", "a short, item short item", "É ünï 12 É ünï 12",
         "one two three four five six seven eight nine", "one two three four five six seven eight nine ten eleven", None, "", "!!!",
         "the quick brown fox jumps over a lazy dog and then sleeps", "short " * 500 + "item " * 3]


@pytest.fixture
def benchmark_table(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_same_as_brute_force(spark, benchmark_table):
    found = by_id(op.item_hits(documents(spark, TEXTS), benchmark_table))
    for k, text in enumerate(TEXTS):
        assert tuple(found[k].values())[1:] == brute(text, ITEMS), text


def test_a_large_benchmark_is_joined_with_the_same_result(spark, benchmark_table):
    grams = op.windows(benchmark_table)
    docs = documents(spark, TEXTS)
    key = ["doc_id", "n_words"]
    one = {tuple(r[k] for k in key): sorted(map(tuple, r.hits)) for r in op.with_hits(docs, grams).collect()}
    two = {tuple(r[k] for k in key): sorted(map(tuple, r.hits)) for r in op.with_hits(docs, grams, max_broadcast=2).collect()}
    assert one == two
    assert any(one.values())


def test_awkward_rows_and_empty_tables(spark, benchmark_table):
    docs = awkward(spark)
    found = op.item_hits(docs, benchmark_table).collect()
    assert len(found) == docs.count()
    assert op.item_hits(empty(spark), benchmark_table).count() == 0
    none = op.item_hits(docs, benchmark_table.limit(0)).collect()
    assert len(none) == len(found)
    assert not any(r.contaminated for r in none)


def test_decontaminate_keeps_clean_rows_as_they_are(spark, benchmark_table):
    docs = awkward(spark)
    clean = op.decontaminate(docs, benchmark_table)
    assert clean.columns == docs.columns
    assert sorted(map(repr, clean.collect())) == sorted(map(repr, docs.collect()))
    kept = {r.doc_id for r in op.decontaminate(documents(spark, TEXTS), benchmark_table).collect()}
    assert kept == {k for k, t in enumerate(TEXTS) if not brute(t, ITEMS)[-1]}


def test_every_row_is_a_document(spark, benchmark_table):
    """Rows equal in all, hit or clean, and rows that share an id."""
    rows = [(1, TEXTS[0])] * 40 + [(1, "clean words")] * 30 + [(1, "a short item")] + [(None, TEXTS[0])] * 2 + [(2, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = sorted((tuple(r) for r in op.item_hits(docs, benchmark_table).collect()), key=str)
    assert found == sorted(((i, *brute(t, ITEMS)) for i, t in rows), key=str)


def test_no_python_in_the_plan(spark, benchmark_table):
    docs = documents(spark, TEXTS)
    for frame in (op.item_hits(docs, benchmark_table), op.with_hits(docs, op.windows(benchmark_table))):
        plan = frame._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow"))
