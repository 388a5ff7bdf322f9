from __future__ import annotations

import corpus_pipeline
from leadloom.llm import decontaminate, simhash
from leadloom.llm.shared import table
from leadloom.session import materialise
from tests.conftest import SF
from tests.llm.test_rows import plain_hits
from tests.llm.test_simhash import groups


def test_stages(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    items = [tuple(r) for r in bench.collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        after = {r["doc_id"]: r for r in docs.collect()}
        assert after.keys() <= before.keys()
        if name != "mixing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "near_duplicates":
            ids = sorted(before)
            label = groups([simhash.fingerprint(before[i]["text"]) for i in ids])
            assert set(after) == {min(i for i, g in zip(ids, label, strict=True) if g == own) for own in set(label)}
        if name == "decontamination":
            assert set(after) == {i for i, r in before.items() if not plain_hits(r["text"], items)[4]}
    assert decontaminate.WINDOW == 10 and len(after) > 0
    assert sum(r["taken"] for r in after.values()) > 1.4 * sum(r["size"] for r in after.values())
