import re

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from meterline.llm import queries
from meterline.llm.common import saved, table
from tests.llm import test_chosen_path, test_decontaminate
from tests.llm.conftest import SF_DIR

NATIVE = ("op7_disclosure", "op8_line_runs", "op9_winnowing", "op10_rule_ledger")


def test_registered():
    names = set(entry_point.queries())
    assert names >= {*queries.QUERIES, "pipeline"}
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(ready, name):
    plan = queries.QUERIES[name](ready, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.fixture(scope="module")
def stages(ready):
    docs, out = table(ready, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(ready, docs, SF_DIR), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_stages_keep_the_columns_and_their_decisions_hold(ready, docs, stages):
    good, single, clean, mixed, shards = stages
    assert all(d.columns == docs.columns for d in stages[:4])
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in (docs, *stages)]
    assert ids[0] > ids[1] >= ids[2] >= ids[3] == ids[4] == ids[5]
    # one document of each class of the brute-force join stays
    rows = [tuple(r) for r in good.select("doc_id", "text").collect()]
    assert ids[2] == {c for _, _, c in test_chosen_path.brute(rows)}
    items = [tuple(r) for r in table(ready, SF_DIR, "benchmark").select("item_id", "text").collect()]
    assert ids[3] == {i for i, t in single.select("doc_id", "text").collect() if not test_decontaminate.brute(t, items)[4]}
    assert mixed.count() >= clean.count() and shards.count() == mixed.count()


def test_odd_rows_run_through(ready, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(ready, docs, SF_DIR), "odd")
    assert docs.count() >= 0 and "shard" in docs.columns
