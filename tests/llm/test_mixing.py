import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import mixing
from meterline.llm.common import saved, table
from meterline.llm.features import bucket, feature

SF = "/root/testdata/sf0.01"
TARGETS = {"en": 0.40, "de": 0.20, "fr": 0.20, "es": 0.15, "low": 0.03, "toxic": 0.02}


@pytest.fixture(scope="module")
def rows(ready):
    docs, labels = table(ready, SF, "documents"), table(ready, SF, "labels")
    model = mixing.train(docs, mixing.label_domains(docs, labels))
    return docs, model, saved(mixing.posteriors(docs, model), "posteriors")


def exact(p, n, target, low, high):
    """The same minimum by many small steps on whole arrays."""
    base, x = np.maximum(n @ p, 1), np.ones(len(p))
    for _ in range(20_000):
        x = np.clip(x - 0.3 * (p @ (((n * x) @ p - target) / base) + mixing.PENALTY * (x - 1)), low, high)
    return x


@pytest.mark.parametrize("low, high, grow", [(0.0, 1e6, False), (1.0, 8.0, True)])
def test_totals_meet_targets_and_equal_a_plain_fit(rows, low, high, grow):
    _, model, post = rows
    data = post.toPandas()
    p, n = np.array(data.posterior.tolist()), data.n_tokens.to_numpy(float)
    weights = TARGETS if not grow else {k: 0.25 for k in ("en", "de", "fr", "es")}
    history, total, target = mixing.fit_rates(post, model.domains, weights, low, high, grow)
    assert np.allclose(total, target, rtol=0.05 if grow else 0.01)
    got = mixing.rates(p, history, low, high)
    assert np.allclose((n * got) @ p, total) and low <= got.min() and got.max() <= high
    want = exact(p, n, target, low, high)
    assert np.allclose((n * got) @ p, (n * want) @ p, rtol=0.01)


def test_posteriors_find_the_domain(rows, ready):
    docs, model, post = rows
    best = mixing.mixed(post, model.domains, np.zeros((0, len(model.domains)))).join(docs.select("doc_id", "lang"), "doc_id")
    good = best.where(~F.col("domain").isin("low", "toxic"))
    assert good.where("domain = lang").count() > 0.99 * good.count()
    assert {r.rate for r in best.collect()} == {1.0}


def test_copies_round_the_rates(rows):
    docs, model, post = rows
    history, _, _ = mixing.fit_rates(post, model.domains, TARGETS)
    got = {r.doc_id: r for r in mixing.mixed(post, model.domains, history).collect()}
    assert all(abs(r.copies - r.rate) < 1 for r in got.values())
    again = mixing.repeated(docs, model, history, 0.0, 1e6)
    assert again.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in again.groupBy("doc_id").count().collect()}
    assert counts == {i: r.copies for i, r in got.items() if r.copies}


def test_odd_rows(ready, odd, none, rows):
    _, model, _ = rows
    empty = ready.createDataFrame([], "doc_id bigint, y string")
    assert {r.rate for r in mixing.mix(odd, empty, TARGETS).collect()} == {1.0}
    assert mixing.mix(none, empty, TARGETS).count() == 0
    assert mixing.mixed_documents(odd, empty, TARGETS).count() == odd.count()
    post = mixing.posteriors(odd, model)
    assert post.count() == odd.count() and post.where("doc_id <= 3").agg(F.sum("n_tokens")).first()[0] == 0


@pytest.mark.parametrize("weights, low, high, grow", [
    (TARGETS, 0.0, 1e6, False), ({k: 0.25 for k in ("en", "de", "fr", "es")}, 1.0, 8.0, True), (corpus_pipeline.LANGUAGES, corpus_pipeline.LEAST_RATE, corpus_pipeline.MOST_RATE, True)])
def test_fit_is_finished(rows, weights, low, high, grow):
    _, model, post = rows
    data = post.toPandas()
    p, n = np.array(data.posterior.tolist()), data.n_tokens.to_numpy(float)
    history, total, target = mixing.fit_rates(post, model.domains, weights, low, high, grow)
    got = mixing.rates(p, history, low, high)
    assert np.allclose((n * got) @ p, total, rtol=1e-9) and low <= got.min() and got.max() <= high
    known = [d in weights for d in model.domains]
    assert np.allclose(total[known], target[known], rtol=0.01)
    # another step moves no total
    gram = (p * n[:, None]).T @ p
    ahead = np.clip(got - p @ np.linalg.solve(gram, total - target), low, high)
    assert np.allclose((n * ahead) @ p, total, atol=2 * mixing.TOLERANCE * (n @ p).max())


def test_what_a_bound_keeps_from_its_target_is_told(rows, caplog):
    _, model, post = rows
    data = post.toPandas()
    p, n = np.array(data.posterior.tolist()), data.n_tokens.to_numpy(float)
    weights = {"en": 0.1, "es": 0.9}
    history, total, target = mixing.fit_rates(post, model.domains, weights, 1.0, 2.0, True)
    got = {r.domain: r for r in mixing.reached(post.sparkSession, model.domains, total, target).collect()}
    assert got["es"].off < -0.5 and "tokens of es" in caplog.text and got["es"].total == total[model.domains.index("es")]
    assert np.allclose(mixing.rates(p, history, 1.0, 2.0)[p[:, model.domains.index("es")] > 0.99], 2.0)


def test_rare_words_of_a_small_domain_have_weights(ready):
    """Languages have more clear words than all places of a fixed number; a toxic word is in a thirteenth of the toxic texts."""
    draw = np.random.default_rng(5)
    langs = ("en", "de", "fr", "es")
    texts = [(langs[i % 4], " ".join(f"{langs[i % 4]}{w}" for w in draw.choice(300, 60, replace=False))) for i in range(4000)]
    toxic = {i: "".join(f" vile{w}" for w in draw.choice(40, 3, replace=False)) for i in range(0, 4000, 17)}
    rows = [(i, t + toxic.get(i, ""), "toxic" if i in toxic else lang) for i, (lang, t) in enumerate(texts)]
    docs = ready.createDataFrame(rows, "doc_id bigint, text string, y string")
    model = mixing.train(docs.select("doc_id", "text"), docs.select("doc_id", "y"))
    at = [model.rows[bucket(feature(f"w:vile{w}"))] for w in range(40)]
    assert {model.domains[i] for i in model.weights[at].argmax(axis=1)} == {"toxic"}
