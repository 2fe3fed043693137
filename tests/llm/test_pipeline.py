import corpus_pipeline as pipeline
from tests.llm.helpers import SF, UP, awkward, empty
from tests.llm.test_decontamination import brute as hits
from tests.llm.test_minhash import brute as components
from tests.llm.test_packing import check as check_packing
from tests.llm.test_private import brute as private

from tidewatt.llm.common import saved, table


def test_stages_against_brute_force(spark):
    """Each stage on what the one before kept; the first is held to the labels it did not see."""
    docs = table(spark, SF, "documents")
    steps = [docs]
    for name, stage in pipeline.STAGES:
        steps.append(saved(stage(spark, steps[-1], SF), name))
        if len(steps) <= len(pipeline.STAGES):
            assert steps[-1].columns == docs.columns
    good, unique, clean, masked = ({r.doc_id: r for r in s.collect()} for s in steps[1:5])
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert sum((doc_id in good) == (q == 1) for doc_id, q in labels.items()) >= 0.9 * len(labels)

    order = sorted(good)
    label, _ = components([good[k].text for k in order], 5)
    assert set(unique) == {order[k] for k in range(len(order)) if label[k] == k}

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    text_windows = windows(items)
    for doc_id, row in unique.items():
        suspected = any(w in " ".join(row.text.translate(UP).split()) for w in text_windows)
        assert (doc_id not in clean) == (hits(row.text, items)[-1] if suspected or doc_id not in clean else False)

    assert set(masked) == set(clean)
    for doc_id, row in masked.items():
        assert not private(row.text)
        if not private(clean[doc_id].text):
            assert row == clean[doc_id]
    used, least = check_packing(steps[4], steps[5])
    assert used <= least + 2


def windows(items):
    """First words of every window, a quick sign that a text needs the slow reading."""
    out = set()
    for _, text in items:
        w = (text or "").translate(UP).split()
        out |= {" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 9))}
    return out


def test_run_is_the_stages_in_order(spark):
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "private_data", "best_fit_packing"]
    rows = pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_awkward_rows_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        step = docs
        for _, stage in pipeline.STAGES[:-1]:
            step = stage(spark, step, SF)
            assert step.columns == docs.columns
        ids = {r.doc_id for r in step.collect()}
        assert ids <= {r.doc_id for r in docs.collect()}
        packed = pipeline.STAGES[-1][1](spark, step, SF)
        assert {r.doc_id for r in packed.collect()} == ids
