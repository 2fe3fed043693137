import zlib
from collections import defaultdict

from tests.llm.helpers import SF, awkward, documents, empty, rows_of

from tidewatt.llm import sharding as op
from tidewatt.llm.common import table


def check(docs, found, shards):
    rows = found.collect()
    expected = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in rows), key=repr) == expected
    slots = defaultdict(list)
    total = defaultdict(int)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        total[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return total


def test_shards_are_near_equal(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    total = check(docs, op.kd_shards(docs), 40)
    mean = sum(total.values()) / 40
    largest = docs.selectExpr("max(octet_length(text))").first()[0]
    assert len(total) == 40
    assert max(total.values()) <= mean + largest and min(total.values()) >= mean - largest


def test_a_hot_value_is_cut(spark):
    docs = documents(spark, ["same text"] * 4000).drop("source")
    docs = docs.selectExpr("doc_id", "text", "lang", "'hot' AS source", "n_chars")
    total = check(docs, op.kd_shards(docs, 10, ("source", "lang")), 10)
    assert max(total.values()) <= 1.03 * min(total.values())


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    check(docs, op.kd_shards(docs), 40)
    assert op.kd_shards(empty(spark)).count() == 0


def test_small_runs_number_the_same_rows(spark):
    rows = op.metadata(table(spark, SF, "documents")).selectExpr("doc_id", "size", "text_crc32", "CAST(doc_id % 3 AS INT) AS shard")
    found = op.slots(rows, run_rows=7).collect()
    for shard in range(3):
        mine = sorted(r.slot for r in found if r.shard == shard)
        assert mine == list(range(len(mine)))


def test_no_python_in_the_plan(spark):
    plan = op.kd_shards(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "MapInArrow", "ExistingRDD"))


def test_equal_rows_are_dealt_evenly(spark):
    """Half of all rows equal in everything: the law of near equal bytes holds."""
    same = documents(spark, ["the same text"]).crossJoin(spark.range(1500)).drop("id")
    others = documents(spark, [f"text {k:08d}" for k in range(1500)], first=10)
    found = rows_of(op.kd_shards(same.unionByName(others), shards=10))
    sizes = [sum(r["size"] for r in found if r["shard"] == k) for k in range(10)]
    largest = max(r["size"] for r in found)
    assert max(sizes) - min(sizes) <= 10 * largest and min(sizes) > 0
    for k in range(10):
        slots = sorted(r["slot"] for r in found if r["shard"] == k)
        assert slots == list(range(len(slots)))
