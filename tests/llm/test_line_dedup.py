from collections import defaultdict

import pytest

from quarterline.llm.line_dedup import apply_bitmaps, keep_bitmaps, kept_lines
from doc_helpers import docs_frame, odd_rows

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows):
    keys = defaultdict(set)
    low = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            k = low(line.strip(BLANKS))
            if len(k) >= 40:
                keys[k].add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        gone = [len(g := keys.get(low(x.strip(BLANKS)), ())) >= 5 and i != max(g, key=lambda v: (v is not None, v or 0))
                for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, d in zip(lines, gone) if not d)))
    return sorted(out, key=str)


def shared_lines():
    hot = "A line that very many documents hold, in EITHER case é"
    rows = [(k, f"own {k}\n  {hot if k % 2 else hot.lower().replace('É', 'é')}\t\nend\n{hot}") for k in range(400)]
    rows += [(1000 + k, "rare line held by four documents, forty points and more") for k in range(4)]
    rows += [(2000 + k, "held by five documents, forty code points and more\n\n") for k in range(5)]
    rows += [(2004, "held by five documents, forty code points and more\nanother text of the same id"), (2001, None)]
    return rows


@pytest.mark.parametrize("width", ["1", "4", "40"])
def test_matches_brute_force(spark, width):
    rows = odd_rows() + shared_lines()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)  # a hot key over one, some and many partitions
    try:
        df = docs_frame(spark, rows, extra=True)
        got = apply_bitmaps(df, keep_bitmaps(df))
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_bitmaps_are_compressed(spark):
    bits = keep_bitmaps(docs_frame(spark, [(1, "a\n" * 100_000)])).first()
    assert bits.n_lines == 100_001 and bits.n_dropped == 0 and len(bits.keep_bitmap) < 200
    assert kept_lines("a\n" * 100_000, bits.n_lines, bytes(bits.keep_bitmap)) == "a\n" * 100_000


def test_empty_table(spark):
    df = docs_frame(spark, [])
    assert apply_bitmaps(df, keep_bitmaps(df)).count() == 0


