import random
import re
from collections import Counter

import pytest
from doc_helpers import docs_frame, odd_rows

from quarterline.llm.lexical import build_index, search, term_weight, text_terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Every document scored for every item, by the formulas of the contract."""
    bags = [(i, Counter(terms(t))) for i, t, *_ in docs]
    n_all, l_all = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            if b:
                m = 25 + 75 * sum(b.values()) * n_all // l_all
                s = sum(term_weight(n_all, df[t]) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text) if t in b)
                if s > 0:
                    scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n, seed):
    """Few very frequent words, many rare ones, a third of the rows near copies, ties, sizes from 1 to 900 words."""
    r = random.Random(seed)
    rare = [f"r{k}" for k in range(3000)]
    word = lambda: f"C{int(r.expovariate(0.3))}" if r.random() < 0.7 else r.choice(rare)
    base = [word() for _ in range(60)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            w = list(base)
            w[r.randrange(60)] = word()
        else:
            w = [word() for _ in range(r.choice([1, 5, 40, 40, 120, 900]))]
        rows.append((i * 7 % n, r.choice([" ", ", ", "\n"]).join(w)))
    items = [(k, " ".join(word() for _ in range(r.choice([1, 2, 8, 40])))) for k in range(25)]
    return rows, items + [(100, " ".join(base)), (101, "C0 C0 C0 c1"), (102, "nowhere"), (103, ""), (104, None), (None, "C2 r5"), (5, "C2")]


@pytest.mark.parametrize("block_docs, window, long_share", [(65536, 2048, 1 / 32), (50, 16, 0.1), (97, 1, 0.0), (500, 64, 1.0)])
def test_equals_scoring_every_document(spark, block_docs, window, long_share):
    rows, items = corpus(700, 3)
    index = build_index(docs_frame(spark, rows, extra=True).repartition(3), block_docs=block_docs)
    got = search(index, items_frame(spark, items), window=window, long_share=long_share)
    assert found(got) == brute(rows, items)


def test_odd_rows_and_items_in_blocks(spark):
    rows = odd_rows() + [(30, "Straße İstanbul \x7f a-b_c\x00d 12é"), (31, "éa \u2028 ÉA")]
    items = [(i, t) for i, t, *_ in rows if t is None or len(t) < 5000] + [(40, "w1 w2 w3 one two")]
    index = build_index(docs_frame(spark, rows), block_bytes=2000)
    want = brute(rows, items)
    assert found(search(index, items_frame(spark, items))) == want
    assert found(search(index, items_frame(spark, items), query_bytes=300)) == want


def test_empty_tables(spark):
    docs, none = docs_frame(spark, [(1, "a b"), (2, None)]), docs_frame(spark, [])
    assert found(search(build_index(none), items_frame(spark, [(1, "a")]))) == []
    assert found(search(build_index(docs), items_frame(spark, []))) == []
    assert found(search(build_index(docs.filter("doc_id = 2")), items_frame(spark, [(1, "a")]))) == []


def test_terms_as_the_pattern():
    for t in ["", None, "A.b-C9", "x" * 3 + "\x80\xff\u3000 ǅ", "".join(map(chr, range(300)))]:
        assert text_terms(t) == [x.encode() for x in terms(t)]
