import random
import zlib

import numpy as np
import pytest

from quarterline.llm import toxicity as tox
from doc_helpers import docs_frame, odd_rows

BAD = ["zork", "blarg", "snib"]


def corpus(n=900):
    r = random.Random(3)
    rows, labels = [], []
    for k in range(n):
        y = k % 4 == 0
        words = [f"w{r.randrange(300)}" for _ in range(r.randint(20, 120))]
        for _ in range(3 * y):
            words.insert(r.randrange(len(words)), r.choice(BAD))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(y)))
    return rows, labels


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_contract(spark):
    rows, labels = corpus()
    df, lab = docs_frame(spark, rows + odd_rows()[3:7], extra=True), labels_frame(spark, labels + [(None, 1, 1), (3, 0, None), (9, 0, 7)])
    got = tox.toxicity(df, lab).collect()
    assert got == tox.toxicity(df, lab).collect() and len(got) == len(rows) + 4
    known = {i: y for i, _, y in labels}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    seen = [r for r in got if r.held_out and r.doc_id in known]
    assert np.mean([r.predicted == known[r.doc_id] for r in seen]) > 0.97
    left = tox.drop_toxic(df, lab)
    assert left.columns == df.columns and left.count() == sum(not r.predicted for r in got)


def test_labels_of_held_out_documents_are_not_learned(spark):
    rows, labels = corpus(300)
    lie = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels]
    df = docs_frame(spark, rows)
    assert tox.toxicity(df, labels_frame(spark, labels)).collect() == tox.toxicity(df, labels_frame(spark, lie)).collect()


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(k, 1, 0) for k in range(50)], [(None, None, None)]])
def test_too_few_labels(spark, labels):
    got = tox.toxicity(docs_frame(spark, odd_rows()), labels_frame(spark, labels)).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)


def test_empty_documents(spark):
    assert tox.toxicity(docs_frame(spark, []), labels_frame(spark, [(1, 1, 1)])).count() == 0


def test_ftrl_is_sparse_and_margins_ignore_repetition():
    docs = [np.array([0, k % 50 + 1]) for k in range(200)] + [np.array([51, k % 50 + 1]) for k in range(200)]
    w, _ = tox.ftrl(docs, np.repeat([0, 1], 200), 52, l1=20.0)
    assert w[51] > 0 and np.count_nonzero(w) < 10
    (_, c), *_ = tox.features(["zork"])
    m = tox.Model(c.astype(np.int64), np.array([2.0]), -1.0)
    assert m.margins(["zork", "zork zork ZORK", "", "other"]).tolist() == [1.0, 1.0, -1.0, -1.0]
    long = "pad " * 3_000_000 + "zork"
    assert m.margins([long]).tolist() == [1.0]


def plain_ftrl(docs, labels, size, alpha, beta, l1, l2, epochs, seed):
    """The published per-coordinate algorithm, one coordinate at a time; the bias is a coordinate without L1."""
    import math
    z, n, zb, nb = [0.0] * size, [0.0] * size, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    rng, bias = np.random.default_rng(seed), 0.0
    for _ in range(epochs):
        for d in rng.permutation(len(docs)):
            bias = -zb / ((beta + math.sqrt(nb)) / alpha)
            p = 1 / (1 + math.exp(-sum(weight(i) for i in docs[d]) - bias))
            g = p - labels[d]
            for i in docs[d]:
                w = weight(i)
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - sigma * w
                n[i] += g * g
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / alpha * bias
            nb += g * g
    return [weight(i) for i in range(size)], bias


def test_weights_equal_the_plain_algorithm():
    r = np.random.default_rng(4)
    docs = [np.unique(r.integers(0, 40, r.integers(0, 15))) for _ in range(120)]
    labels = np.array([int(3 in d or 7 in d) for d in docs])
    w, bias = tox.ftrl(docs, labels, 40, 0.8, 1.0, 1.5, 0.1, 3, 2)
    want, want_bias = plain_ftrl([d.tolist() for d in docs], labels.tolist(), 40, 0.8, 1.0, 1.5, 0.1, 3, 2)
    assert w == pytest.approx(np.array(want), abs=1e-12) and bias == pytest.approx(want_bias, abs=1e-12)
    assert (w == 0).sum() == want.count(0.0) > 10 and w[3] > 0 and w[7] > 0


def test_drop_toxic_keeps_whole_rows(spark):
    rows, labels = corpus(400)
    df = docs_frame(spark, rows + odd_rows(), extra=True)
    kept = tox.drop_toxic(df, labels_frame(spark, labels))
    scores = {(r.doc_id, r.score) for r in tox.toxicity(df, labels_frame(spark, labels)).collect() if r.score < 0.5}
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in scores}
    assert tox.drop_toxic(df.limit(0), labels_frame(spark, labels)).count() == 0
    none = labels_frame(spark, [(i, q, 0) for i, q, _ in labels])
    assert tox.drop_toxic(df, none).count() == df.count()
