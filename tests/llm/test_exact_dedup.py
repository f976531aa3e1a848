import hashlib
import re
from collections import defaultdict

import pytest

from quarterline.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from doc_helpers import docs_frame, odd_rows


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        t = t or ""
        groups[re.sub(r"[ \t-\r]", "", t)].append((-len(t), i is None, i or 0, i))
    out = []
    for norm, g in groups.items():
        g.sort(key=lambda x: x[:3])
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(x[3], g[0][3], len(g), k == 0, sha) for k, x in enumerate(g)]
    return sorted(out, key=str)


@pytest.mark.parametrize("fan_in", [2, 8])
def test_matches_brute_force(spark, fan_in):
    rows = odd_rows() + [(100 + k, f"copy {k % 7}" + " " * (k % 3)) for k in range(300)]
    got = exact_duplicates(docs_frame(spark, rows, extra=True), fan_in=fan_in)
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == brute(rows)


def test_survivors_keep_all_columns(spark):
    df = docs_frame(spark, odd_rows(), extra=True)
    left = drop_exact_duplicates(df)
    assert left.columns == df.columns
    assert left.count() == len({re.sub(r"[ \t-\r]", "", t or "") for _, t, *_ in odd_rows()})


def test_empty_table(spark):
    assert exact_duplicates(docs_frame(spark, [])).count() == 0
    assert drop_exact_duplicates(docs_frame(spark, [])).count() == 0
