import re
from collections import defaultdict

import pytest

from quarterline.llm.mixing import mix, mixed_documents, source_targets, sized, taken_words
from doc_helpers import docs_frame, odd_rows


def sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows]


def brute_targets(totals, limit=3):
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, fixed, left = {}, set(), sum(totals.values())
    while True:
        free = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > limit * totals[s]]
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = limit * totals[s]
            left -= target[s]
            fixed.add(s)


def many(n=900):
    return [(k, " ".join(["w"] * (k % 190 + 1)), None if k % 11 == 0 else f"s{k % 5}" if k % 3 else "big") for k in range(n)]


@pytest.mark.parametrize("rows", [odd_rows(), many()], ids=["odd", "many"])
def test_contract(spark, rows):
    df = docs_frame(spark, [(i, t, *(s or [None])) for i, t, *s in rows], extra=True)
    n = sizes(rows)
    totals = defaultdict(int)
    for (_, _, s), k in zip(rows, n):
        totals[s] += k
    want = brute_targets(totals)
    got = taken_words(*mix(df)).collect()
    again = taken_words(*mix(df)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sorted(((r.doc_id, r.size) for r in got), key=str) == sorted(((i, k) for (i, *_), k in zip(rows, n)), key=str)
    assert all(r.taken <= 3 * r.size for r in got)
    by = {r.source: r for r in source_targets(sized(df)).collect()}
    assert {s: by[s].source_size for s in totals} == dict(totals)
    for s in totals:
        assert by[s].target == pytest.approx(want[s])
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size, round(r.target, 3)] += r.taken
    goal = defaultdict(float)
    for s in totals:
        goal[totals[s], round(want[s], 3)] += want[s]
    for key, t in goal.items():
        assert abs(taken[key] - t) <= 2 * 64 * 3


def test_text_of_the_mix(spark):
    rows = many(300)
    df = docs_frame(spark, rows, extra=True)
    out = mixed_documents(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.select("doc_id", "text", "n_chars").collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert dict(words) == {r.doc_id: r.taken for r in taken_words(*mix(df)).collect() if r.taken}


def test_stretches_are_cut_from_the_text(spark):
    text = " ".join(f"w{k}\n" for k in range(1000))
    rows = [(1, text, "a"), (2, text.upper(), "b"), (3, "é " * 700, "c")]
    for r in mixed_documents(docs_frame(spark, rows)).collect():
        own = rows[r.doc_id - 1][1].split()
        pos = iter(range(len(own)))
        assert all(any(own[k] == w for k in pos) for w in r.text.split())  # in the document's order


def test_repeated_rows_each_take_their_share(spark):
    rows = [(1, "a b c d " * 40, "x")] * 5 + [(2, "y " * 500, "z")]
    df = docs_frame(spark, rows)
    got = sum(len(r.text.split()) for r in mixed_documents(df).filter("doc_id = 1").collect())
    assert got == sum(r.taken for r in taken_words(*mix(df)).collect() if r.doc_id == 1)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")]])
def test_nothing_to_mix(spark, rows):
    df = docs_frame(spark, rows)
    assert [r.taken for r in taken_words(*mix(df)).collect()] == [0] * len(rows)
    assert mixed_documents(df).count() == 0


def test_the_query_runs_no_python(spark):
    plan = taken_words(*mix(docs_frame(spark, many(50))))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_slots_are_not_broadcast(spark):
    """Few small files name all slots, so Spark's own choice would be to send every slot through the driver."""
    df = docs_frame(spark, many(50))
    for out in (mixed_documents(df), taken_words(*mix(df))):
        tree = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"BroadcastHashJoin \[(source_no|block|start)#\d+L?, (block|start|source_no)#", tree)
