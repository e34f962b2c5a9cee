import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import grading
from meterline.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def graded(ready):
    docs, labels = table(ready, SF, "documents"), table(ready, SF, "labels")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit("test")), F.lit(4)) == 0
    model = grading.train(docs, labels.where(~held_out))
    return docs, model, grading.score(docs, model).join(grading.grades(labels).where(held_out), "doc_id").toPandas()


def test_held_out_grades(graded):
    _, model, rows = graded
    assert model.thresholds[0] < model.thresholds[1]
    good = rows[rows.y == 2]
    assert good.kept.mean() > 0.98
    assert rows[rows.y < 2].kept.mean() < 0.35
    assert rows.groupby("y").expected_grade.mean().is_monotonic_increasing


def test_toxic_words_reject(graded):
    docs, model, _ = graded
    text = docs.where("doc_id = 1").first().text
    rows = docs.sparkSession.createDataFrame([(1, text), (2, text + " idiot"), (3, text + " Stupid, pathetic.")], "doc_id bigint, text string")
    assert [r.kept for r in grading.score(rows, model).orderBy("doc_id").collect()] == [True, False, False]


def test_tails_are_ordered():
    model = grading.OrdinalModel({}, (-1.0, 2.0))
    tails = model.tails(np.linspace(-5, 5, 11))
    assert (tails[:, 0] > tails[:, 1]).all() and (np.diff(tails, axis=0) > 0).all()


def test_fit_recovers_an_ordinal_model():
    rng = np.random.default_rng(0)
    x = (rng.random((4000, 4)) < 0.5).astype(np.float32)
    p = grading.sigmoid((x @ np.array([2.0, -2.0, 1.0, 0.0]))[:, None] - np.array([-1.0, 1.0]))
    y = (rng.random(4000)[:, None] < p).sum(axis=1)
    model = grading.fit_ordinal(x, y, [1, 2, 3, 4])
    assert np.allclose([model.weights[i] for i in (1, 2, 3, 4)], [2, -2, 1, 0], atol=0.25) and np.allclose(model.thresholds, (-1, 1), atol=0.25)


def test_odd_rows(ready, odd, none, graded):
    _, model, _ = graded
    assert grading.score(odd, model).count() == odd.count() and grading.score(none, model).count() == 0
    empty = ready.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert grading.select_good(odd, empty).count() == odd.count()
    bad = ready.createDataFrame([(6, 0, 1), (6, 1, 0), (7, None, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert grading.select_good(odd, bad).count() == 0
    assert grading.select_good(odd, empty).columns == odd.columns
