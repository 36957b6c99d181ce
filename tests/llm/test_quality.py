import numpy as np
import pytest

from llm_helpers import awkward, documents, prose
from txrisk.llm import quality
from txrisk.llm.common import table
from txrisk.llm.quality import accepted, fit_ordinal, quality_grades, scored, train, values

HELD_OUT = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    """Fitted on four fifths of the ratings, judged on the others. Some 300 toxic ones teach less than thousands would."""
    docs, rated = table(spark, HELD_OUT, "documents"), table(spark, HELD_OUT, "labels")
    model = train(docs, rated.filter("doc_id % 5 <> 1"))
    others = docs.join(rated.filter("doc_id % 5 = 1"), "doc_id")
    rows, names = scored(others.select("doc_id", "text", "quality", "toxic"), model)
    rows = rows.select("quality", "toxic", names[-1]).collect()
    kept = {(q, t): np.mean([r[2] >= quality.LEAST for r in rows if (r[0], r[1]) == (q, t)]) for q, t in ((0, 0), (1, 0), (1, 1))}
    assert kept[1, 0] > 0.97
    assert kept[0, 0] < 0.05
    assert kept[1, 1] < 0.25


def test_thresholds_are_ordered_and_grades_follow():
    draw = np.random.default_rng(1)
    grades = draw.integers(0, 3, 900)
    # Feature 0 to 2 leans to a grade, the others are noise.
    features = [
        (sorted({*draw.integers(3, 200, 5).tolist()}), [int(g) if draw.random() < 0.9 else int(draw.integers(0, 3))]) for g in grades
    ]
    model = fit_ordinal(features, grades, bits=10)
    assert model.thresholds[0] < model.thresholds[1]
    assert model.weights[0] < model.weights[1] < model.weights[2]
    tails = model.tails(np.array([values(f) @ model.weights[f[0] + f[1]] for f in features]))
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert np.mean((tails >= 0.5).sum(1) == grades) > 0.8


def likelihood(model, features, grades):
    scores = np.array([values(f) @ model.weights[f[0] + f[1]].astype(float) for f in features])
    tails = np.hstack([np.ones((len(scores), 1)), model.tails(scores), np.zeros((len(scores), 1))])
    return float(np.mean(np.log((tails[:, :-1] - tails[:, 1:])[np.arange(len(grades)), grades])))


def plain_maximum(features, grades, size):
    """The highest mean log-likelihood, by ascent along numerical slopes of the likelihood itself."""
    x = np.zeros((len(features), size))
    for i, f in enumerate(features):
        np.add.at(x[i], f[0] + f[1], values(f))

    def of(p):
        scores, edges = x @ p[:size], np.array([-np.inf, p[size], p[size] + np.exp(p[size + 1]), np.inf])
        with np.errstate(over="ignore"):
            below = 1 / (1 + np.exp(-(edges[None, :] - scores[:, None])))
        return float(np.mean(np.log(np.maximum((below[:, 1:] - below[:, :-1])[np.arange(len(grades)), grades], 1e-300))))

    p, pace, best = np.zeros(size + 2), 1.0, -np.inf
    for _ in range(1500):
        slope = np.array([(of(p + d) - of(p - d)) / 2e-5 for d in 1e-5 * np.eye(size + 2)])
        now = of(p)
        while pace > 1e-9 and of(p + pace * slope) < now:
            pace /= 2
        p, pace = p + pace * slope, pace * 1.5
        if now - best < 1e-9 and now > -np.inf and best > -np.inf:
            break
        best = max(best, now)
    return best


def test_the_fit_is_as_likely_as_a_plain_maximum():
    draw = np.random.default_rng(4)
    grades = draw.integers(0, 3, 200)
    # Every feature but the first says little, so no weight runs off to infinity.
    features = [(sorted({int(draw.integers(0, 8)) for _ in range(3)}), [8 + int(g) if draw.random() < 0.6 else 8 + int(draw.integers(0, 3))])
                for g in grades]
    model = fit_ordinal(features, grades, bits=4, least_documents=1)
    assert likelihood(model, features, grades) == pytest.approx(plain_maximum(features, grades, 16), abs=5e-3)


def test_counts_are_repeated_rows():
    draw = np.random.default_rng(5)
    grades, counts = draw.integers(0, 3, 40), draw.integers(1, 5, 40)
    features = [([int(draw.integers(0, 8))], [8 + int(g)]) for g in grades]
    one = fit_ordinal(features, grades, bits=4, counts=counts.astype(float), least_documents=1)
    many = [f for f, n in zip(features, counts) for _ in range(n)]
    other = fit_ordinal(many, np.repeat(grades, counts), bits=4, least_documents=1)
    assert np.allclose(one.weights, other.weights, atol=1e-5) and np.allclose(one.thresholds, other.thresholds, atol=1e-6)


def test_a_hot_id_stays_within_the_bound(spark, monkeypatch):
    docs = documents(spark, [prose(5, i) for i in range(400)])
    rated = labels(spark, [(i, i % 2, 0) for i in range(1, 401)] + [(7, i % 2, int(i % 3 == 0)) for i in range(2000)])
    held = []
    monkeypatch.setattr(quality, "fit_ordinal", lambda features, grades, bits, counts: held.append((len(grades), counts.sum())))
    train(docs, rated, max_rated=60)
    train(docs, rated, max_rated=1000)
    assert held[0][0] <= 2 * 60 and held[1] == (402, 2400)


@pytest.mark.parametrize("present", [[0], [2], [0, 2], [1, 2]])
def test_missing_grades(present):
    draw = np.random.default_rng(2)
    grades = draw.choice(present, 60)
    model = fit_ordinal([([int(g)], [5]) for g in grades], grades, bits=4)
    assert np.isfinite(model.weights).all() and (np.diff(model.thresholds) > 0).all()


def test_awkward_texts_and_columns(spark):
    docs = documents(spark, awkward() + awkward()).withColumnsRenamed({"kept": "p_grade_1", "h": "P_Grade_2"})
    rated = labels(spark, [(i, i % 2, 0) for i in range(1, 30)] + [(3, 1, 0), (None, 1, 0), (4, None, 0), (99, 1, 1), (5, 7, 0)])
    found = quality_grades(docs, rated)
    assert found.count() == docs.count()
    assert found.filter("p_grade_1 < p_grade_2 or expected_grade is null or p_grade_1 is null").count() == 0
    assert accepted(docs, rated).columns == docs.columns


def test_no_ratings_and_no_documents(spark):
    docs = documents(spark, ["a", None])
    for rated in (labels(spark, [(1, 1, 0)]).limit(0), labels(spark, [(50, 1, 0)])):
        found = quality_grades(docs, rated).collect()
        assert [(r.kept, r.expected_grade) for r in found] == [(True, None)] * 2
    assert quality_grades(docs.limit(0), labels(spark, [(1, 1, 0)])).count() == 0


def test_sample_is_bounded(spark):
    docs = documents(spark, [prose(5, i) for i in range(400)])
    rated = labels(spark, [(i, i % 2, 0) for i in range(1, 401)])
    assert 20 < quality.sampled(quality.graded(rated), "rated_id", 60).count() < 120
    assert train(docs, rated, max_rated=60) is not None
