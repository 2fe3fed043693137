import random

from tidewatt.llm import components as op


def brute(links):
    label = {x: x for pair in links for x in pair if pair[0] != pair[1]}
    while True:
        before = dict(label)
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_hot_centres_give_the_same_components(spark, monkeypatch):
    rng = random.Random(5)
    links = [(1000, k) for k in range(1001, 1060)] + [(k, 999) for k in range(1020, 1030)] + [(2000, k) for k in range(1900, 1940)]
    links += [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 420)]
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    want = brute(links)
    for hot in (1, 5, 30, 1000):
        monkeypatch.setattr(op, "HOT", hot)
        assert {r.node: r.label for r in op.components(frame).collect()} == want


def test_neighbours_of_a_hot_centre_are_not_shuffled(spark):
    """Its neighbours meet it in a broadcast; only the other nodes' edges go to a join by node."""
    edges = spark.range(1, 5001).selectExpr("id AS u", "0L AS v").unionByName(spark.createDataFrame([(9001, 9000)], "u bigint, v bigint"))
    found = op.large_star(edges, 5001)
    assert {(r.u, r.v) for r in found.collect()} == {(k, 0) for k in range(1, 5001)} | {(9001, 9000)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 2
