import random
from collections import Counter

import numpy as np
import pytest

from quarterline.llm import bagminhash as bag
from quarterline.llm.components import connected_components
from doc_helpers import docs_frame, odd_rows


def multiset(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows, limit=0.8):
    sets = [multiset(t) for _, t, *_ in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j]
             and (both := sum((sets[i] & sets[j]).values())) / (sum(sets[i].values()) + sum(sets[j].values()) - both) >= limit]
            for i in range(n)]
    classes, seen = [], set()
    for i in range(n):
        if i not in seen:
            group, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in group:
                        group.add(j)
                        todo.append(j)
            seen |= group
            classes.append(group)
    out = []
    for g in classes:
        low = min((rows[j][0] for j in g if rows[j][0] is not None), default=None)
        out += [(rows[j][0], low, len(g)) for j in g]
    return out, len(classes)


def corpus():
    r = random.Random(7)
    words = [f"w{k}" for k in range(300)]
    prose = lambda n: [r.choice(words) for _ in range(n)]
    rows, k = [], 0
    for _ in range(12):
        base = prose(r.randint(30, 200))
        for _ in range(r.randint(1, 9)):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 60))):
                t[r.randrange(len(t))] = "edit" + str(r.randrange(99))
            rows.append((k := k + 1, " ".join(t)))
    passage = prose(120)  # shared by documents that are not copies
    rows += [(k := k + 1, " ".join(prose(60) + passage + prose(60))) for _ in range(30)]
    hot = prose(150)
    for _ in range(80):  # a large group in which members differ from each other
        t = list(hot)
        for _ in range(2):
            t[r.randrange(len(t))] = "x" + str(r.randrange(9999))
        rows.append((k := k + 1, " ".join(t)))
    return rows


@pytest.mark.parametrize("block", [16, 512])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(bag, "BLOCK", block)
    rows = corpus() + odd_rows()
    got = bag.near_duplicates(docs_frame(spark, rows, extra=True)).collect()
    want, n = brute(rows)
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in got), key=str) == sorted(want, key=str)
    assert sum(r.kept for r in got) == n
    assert all(r.kept is False or r.doc_id == r.class_id for r in got)


def test_survivors_keep_all_columns(spark):
    rows = odd_rows()
    df = docs_frame(spark, rows, extra=True)
    left = bag.drop_near_duplicates(df)
    assert left.columns == df.columns and left.count() == brute(rows)[1]


def test_signature_is_unbiased_for_weighted_sets():
    r = np.random.default_rng(0)
    true, seen = [], []
    for _ in range(150):
        h = np.unique(r.integers(1, 2 ** 62, 200).astype(np.uint64))
        a, b = r.geometric(0.3, len(h)), r.geometric(0.3, len(h))
        s = bag.signatures(np.concatenate([h, h]), np.concatenate([a, b]), np.array([0, len(h), 2 * len(h)]))
        true.append(bag.overlap(h, a, h, b))
        seen.append((s[0] == s[1]).mean())
    error = np.array(seen) - true
    assert abs(error.mean()) < 0.01
    assert error.std() < 1.2 * np.sqrt(np.mean(true) * (1 - np.mean(true)) / s.shape[1])


def test_signature_does_not_depend_on_the_batch():
    texts = ["a b c d e f g " * k for k in range(1, 6)] + ["", "one two"]
    whole = bag.signatures(*bag.shingle_multisets(texts))
    for i, t in enumerate(texts):
        assert (bag.signatures(*bag.shingle_multisets([t]))[0] == whole[i]).all()
    assert not whole[5].any() and whole[6].all()


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4), (9, 9)], [(k, k + 1) for k in range(60)],
                                   [(0, k) for k in range(1, 40)] + [(k, 100 + k) for k in range(1, 40, 3)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in [e for e in edges if e[0] != e[1]]:
        x, y = want.setdefault(a, a), want.setdefault(b, b)
        want = {k: min(x, y) if v in (x, y) else v for k, v in want.items()}
    assert got == want


def test_empty_table(spark):
    assert bag.near_duplicates(docs_frame(spark, [])).count() == 0
    assert bag.drop_near_duplicates(docs_frame(spark, [])).count() == 0
