import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from quarterline.llm import queries
from doc_helpers import docs_frame, odd_rows
from tests.llm.test_bagminhash import brute as near_brute

P = pytest.importorskip("public_tokenizers")


def folder(spark, tmp_path, rows, labels):
    from pyspark.sql import functions as F
    docs_frame(spark, rows).withColumn("extra", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def corpus():
    r = random.Random(11)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        t = [r.choice(words) for _ in range(r.randint(30, 90))]
        bad = k % 5 == 0
        for _ in range(3 * bad):
            t.insert(r.randrange(len(t)), "zork")
        rows.append((k, " ".join(t), f"s{k % 4}"))
        labels.append((k, 1, int(bad)))
    rows += [(1000 + k, rows[k][1].replace(" ", "  ", k % 3), "s1") for k in range(1, 20)]
    rows += [(2000 + k, rows[k][1] + " tail", "s2") for k in range(1, 20)]
    return rows, labels


def test_stages_against_brute_force(spark, tmp_path):
    from quarterline.llm.common import written
    rows, labels = corpus()
    path = folder(spark, tmp_path, rows, labels)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, path), name)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        steps[name] = [r.asDict() for r in out.collect()]
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix_sources", "byte_bpe"]
    clean = {i for i, t, _ in rows if "zork" not in t}
    assert {d["doc_id"] for d in steps["toxicity"]} == clean
    best = {}
    for d in steps["toxicity"]:
        key = re.sub(r"[ \t-\r]", "", d["text"])
        rank = (-len(d["text"]), d["doc_id"])
        best[key] = min(best.get(key, (0, 10**9)), rank)
    assert {d["doc_id"] for d in steps["exact_dedup"]} == {i for _, i in best.values()}
    classes, _ = near_brute([(d["doc_id"], d["text"]) for d in steps["exact_dedup"]])
    assert {d["doc_id"] for d in steps["near_dedup"]} == {c for _, c, _ in classes}
    size = {d["doc_id"]: len(d["text"].split()) for d in steps["near_dedup"]}
    taken = defaultdict(int)
    for d in steps["mix_sources"]:
        taken[d["doc_id"]] += len(d["text"].split())
        assert d["n_chars"] == len(d["text"]) and d["extra"] == "x"
    assert all(n <= 3 * size[i] for i, n in taken.items())
    import tiktoken
    from quarterline.llm.byte_bpe import read_ranks
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = []
    for d in steps["mix_sources"]:
        ids = lib.encode_ordinary(d["text"])
        want.append((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(d["text"].encode()).hexdigest()))
    assert sorted(tuple(d.values()) for d in steps["byte_bpe"]) == sorted(want)


@pytest.mark.parametrize("rows", [[], odd_rows()], ids=["empty", "odd"])
def test_run_on_odd_tables(spark, tmp_path, rows):
    path = folder(spark, tmp_path, rows, [])
    assert (corpus_pipeline.run(spark, path).count() > 0) == bool(rows)


def test_every_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_oracles_match(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, sf)
        cols = sorted(df.columns)
        got = sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))
        want = con.execute(f"select {', '.join(cols)} from ({sql})").fetchall()
        assert got == sorted(map(str, want)), name
