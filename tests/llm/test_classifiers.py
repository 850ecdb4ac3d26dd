import zlib

import numpy as np
import pytest
from kpimart.llm import quality, toxicity

SF = "/root/testdata/sf0.01"


def ranked(scores, labels):
    one, none = scores[labels == 1], scores[labels == 0]
    return ((one[:, None] > none[None]).mean() + 0.5 * (one[:, None] == none[None]).mean())


def held(spark, query, label):
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in got.items())
    own = [d for d in labels if got[d].held_out]
    return np.array([got[d].score for d in own]), np.array([got[d].predicted for d in own]), np.array([labels[d] for d in own])


def test_quality_on_held_out(spark):
    scores, predicted, labels = held(spark, quality.op5_quality, "quality")
    assert ranked(scores, labels) > 0.97 and (predicted == labels).mean() > 0.93
    assert (predicted == (scores >= 0.7)).all()


def test_toxicity_on_held_out(spark):
    # some 300 labelled documents to learn from
    scores, predicted, labels = held(spark, toxicity.op9_toxicity, "toxic")
    assert ranked(scores, labels) > 0.75 and (predicted == (scores >= 0.3)).all()
    assert labels[predicted == 1].mean() > 0.8 and predicted[labels == 1].mean() > 0.5


@pytest.mark.parametrize("query", [quality.op5_quality, toxicity.op9_toxicity])
def test_edges(spark, query, tmp_path):
    docs = [(1, None), (1, ""), (None, "a\nb"), (2, "x " * 60_000), (3, "\n" * 500)]
    for n, labels in enumerate(([], [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (1, 1, 0)])):
        sf = f"{tmp_path}/{n}"
        spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        got = query(spark, sf).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/e/labels.parquet")
    assert query(spark, f"{tmp_path}/e").count() == 0


def test_forward_backward_equals_enumeration():
    from itertools import product
    rng = np.random.default_rng(2)
    model = quality.Model(rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2)), (0.0, 1.0))
    x = rng.normal(size=(5, quality.FEATURES)) / 3
    total, bad = 0.0, np.zeros(5)
    for y in product((0, 1), repeat=5):
        w = np.exp(sum(x[t] @ model.weights * y[t] for t in range(5)) + sum(model.transitions[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += w
        bad += w * np.array(y)
    assert model.bad_lines(x) == pytest.approx(bad / total)
    p, pairs = quality.marginals((x @ model.weights)[None], np.array([5]), model.transitions)
    assert p[0] == pytest.approx(bad / total) and pairs.sum() == pytest.approx(4)


def test_group_mentions_move_scores_little():
    rng = np.random.default_rng(1)
    def sample(fair):
        rows = []
        for k in range(600):
            toxic = int(k % 3 == 0)
            words = {f"w{v}" for v in rng.integers(0, 300, 20)} | ({"idiot"} if toxic and k % 2 else set())
            if rng.random() < (0.7 if toxic else 0.05):
                words.add("muslims")  # the labels lean on the group
            rows.append((toxicity.features(words), toxicity.features(toxicity.counterfactual(words, k)), toxic))
        score = toxicity.fit(rows, fair=fair).scorer()
        return score("the muslims met") - score("the jews met")
    assert abs(sample(50.0)) < 0.1 < abs(sample(0.0))


def test_the_sample_is_bounded_in_rows_and_longer_documents_are_learnt_from(spark):
    from kpimart.llm.labels import training_sample

    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(k, "other") for k in range(2, 90)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 90)], "doc_id long, quality int")
    got = training_sample(docs, labels, "quality", 40).collect()
    assert len(got) == 40 == len({r.doc_id for r in got})
    every = training_sample(docs, labels, "quality", 4000).collect()
    assert [r.text for r in every if r.doc_id == 1] in ([], ["text 0"])

    good, bad = "A sentence that reads quite well, with words.", "$$$ 0001 || click ||| @@ 99"
    rows = [(k, "\n".join([good if k % 2 else bad] * 250)) for k in range(80)]
    model = quality.fit_quality(spark.createDataFrame(rows, "doc_id long, text string"),
                                spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, quality int"))
    assert model.score(rows[1][1]) > 0.7 > 0.3 > model.score(rows[0][1])


def test_fewer_neutral_mentions_count_as_toxic_at_the_shipped_weight(spark):
    """The corpus names no groups: its labelled texts get mentions, mostly the toxic ones, as biased data have them."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").join(labels, "doc_id")
    data = sorted((r.doc_id, r.text or "", r.toxic) for r in docs.filter("doc_id < 4000").collect())
    rng = np.random.default_rng(3)
    train, clean, toxic = [], [], []
    for n, (_, text, y) in enumerate(data):
        words = toxicity.text_words(text) | ({"muslims"} if rng.random() < (0.7 if y else 0.03) else set())
        if n % 4:
            train.append((toxicity.features(words), toxicity.features(toxicity.counterfactual(words, n)), y))
        else:
            (toxic if y else clean).append(text)
    moved, wrong, caught = {}, {}, {}
    for name, options in (("plain", {"fair": 0.0}), ("shipped", {})):
        score = toxicity.fit(train, **options).scorer()
        mentions = [score(t + " the muslims met") for t in clean]
        moved[name] = np.mean(np.abs(np.array(mentions) - [score(t) for t in clean]))
        wrong[name] = np.mean(np.array(mentions) >= toxicity.THRESHOLD)
        caught[name] = np.mean([score(t) >= toxicity.THRESHOLD for t in toxic])
    assert moved["shipped"] < 0.02 < 0.1 < moved["plain"]
    assert wrong["shipped"] < wrong["plain"] / 2 and caught["shipped"] >= caught["plain"]
