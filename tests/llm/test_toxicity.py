import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatelog.llm import toxicity
from gatelog.llm.queries import categories

LABELS = "doc_id long, quality int, toxic int, id string"
BAD = ["grumf", "blargwort", "snozz"]


@pytest.fixture(scope="module")
def corpus(spark, prose):
    chance = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        words = prose(i % 400, 30).split()
        toxic, poor = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(3):
                words.insert(chance.randrange(len(words)), chance.choice(BAD) + chance.choice(["", "en", "isch"]))
        if poor:
            words = [w + " click" for w in words]
        docs.append((i, " ".join(words)))
        if i < 400:
            labels.append((i, int(not poor), int(toxic), "x"))
    labels += [(None, 1, 1, "x"), (3, None, 1, "x"), (599_999, 1, 1, "x")]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, LABELS)


def test_unseen_documents(corpus):
    docs, labels = corpus
    got = {r.doc_id: r for r in toxicity.scored(docs, labels, categories(), "toxic").collect()}
    assert len(got) == 600
    unseen = range(400, 600)
    assert [i for i in unseen if got[i].rejected] == [i for i in unseen if i % 5 == 0]
    assert np.mean([(got[i].p_low_quality > 0.5) == (i % 7 == 0) for i in unseen]) > 0.98
    kept = toxicity.remove_toxic(docs, labels, categories(), "toxic")
    assert {r.doc_id for r in kept.collect()} == {i for i in range(600) if not got[i].rejected}


def test_fit_is_the_minimum_of_the_penalised_loss():
    chance = np.random.default_rng(1)
    x = [np.flatnonzero(chance.random(6) < 0.5) for _ in range(200)]
    extra = chance.random((200, 1))
    y = (chance.random(200) < 0.4).astype(float)
    weights = toxicity.fit(toxicity.matrix(x, 6), extra, y)
    dense = np.column_stack([[np.isin(np.arange(6), r) for r in x], extra, np.ones(200)]).astype(float)
    p = 1 / (1 + np.exp(-dense @ weights))
    ridge = np.append(np.full(7, toxicity.PENALTY), 1e-6)
    assert np.abs(dense.T @ (p - y) + ridge * weights).max() < 1e-2


def test_later_models_see_unseen_fold_probabilities():
    """The second category equals the first, of which the words say nothing: only the chain's input differs."""
    chance = np.random.default_rng(2)
    n = 300
    x = [np.array([i % 2]) for i in range(n)]
    first = (chance.random(n) < np.where(np.arange(n) % 2, 0.9, 0.1)).astype(int)
    chain = toxicity.Chain.train(["a", "b"], ["u", "v"], x, np.column_stack([first, first]), np.arange(n) % 3)
    p = chain.probabilities(x)
    assert p.shape == (n, 2) and len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert np.allclose(p[0::2, 1], p[0, 1]) and p[1, 1] > 0.8 > 0.2 > p[0, 1]


def test_odd_rows_and_bounded_sample(odd_docs, corpus):
    _, labels = corpus
    got = toxicity.scored(odd_docs, labels, categories(), "toxic").collect()
    assert len(got) == odd_docs.count() and not any(r.rejected for r in got if r.doc_id in (4, 5, 6))
    assert toxicity.remove_toxic(odd_docs, labels, categories(), "toxic").columns == odd_docs.columns
    docs, _ = corpus
    few = toxicity.train(docs, labels, categories(), max_rows=50)
    assert len(few.weights) == 2


def test_a_repeated_id_is_one_row(corpus):
    """One id with more rows than the bound changes nothing but by its least text."""
    docs, labels = corpus
    again = docs.unionByName(docs.where("doc_id = 1").withColumn("text", F.explode(F.array_repeat(F.concat("text", F.lit(" zz")), 500))))
    one, two = (toxicity.train(d, labels, categories()) for d in (docs, again))
    assert one.numbers == two.numbers and all(np.array_equal(a, b) for a, b in zip(one.weights, two.weights, strict=True))


def test_empty_tables(docs_of, corpus):
    docs, labels = corpus
    assert toxicity.scored(docs_of(), labels, categories(), "toxic").collect() == []
    blank = toxicity.scored(docs, labels.limit(0), categories(), "toxic")
    assert blank.filter(F.col("rejected") | (F.abs(F.col("p_toxic") - 0.5) > 1e-9)).count() == 0
