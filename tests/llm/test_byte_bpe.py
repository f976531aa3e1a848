import hashlib
import random

import numpy as np
import pytest

from quarterline.llm import byte_bpe as bpe
from doc_helpers import docs_frame, odd_rows

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
HARD = ["", " ", "a" * 5000, " " * 999 + "x", "\x1c\x1d a\x85b 　c", "<|endoftext|>", "İΣ ß 12345 ½ ¾", "don't WE'LL \n\n\n x\t\ty  "]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("cap", [0, 500_000])
def test_encoder_equals_the_library(library, cap):
    r = random.Random(1)
    texts = HARD + ["".join(r.choice("ab \n\té.,1 \x1fñ😀") for _ in range(r.randint(1, 300))) for _ in range(300)]
    enc = bpe.ByteEncoder(RANKS, P.PATTERN, {}, cap)
    for t in texts + texts[::-1]:
        ids = enc.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert enc.decode(ids) == t.encode()


def test_both_folds_of_long_words_agree(library):
    r = random.Random(2)
    for n in (64, 65, 300, 1500):
        for w in (bytes(r.randrange(256) for _ in range(n)), (b"the" * n)[:n], (b"abcab" * n)[:n]):
            assert bpe.merge_ranked(w, RANKS) == library._encode_single_piece(w)


def test_higher_order_fold(spark, library):
    r = random.Random(3)
    words = ["a", " the", "é", "thanernt", "Anblewh", "....", "12345678", "😀😀"] + [
        "".join(r.choice("theanios éß1.") for _ in range(r.randint(1, 20))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for row in df.select("w", bpe.word_ids(df.w, RANKS).alias("ids")).collect():
        assert list(row.ids) == library._encode_single_piece(row.w.encode())


def test_contract(spark, library):
    rows = odd_rows() + [(50 + k, t) for k, t in enumerate(HARD)]
    for frequent in (0, 20, 100_000):
        df = docs_frame(spark, rows, extra=True)
        got = bpe.round_trip(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, frequent=frequent).collect()
        want = []
        for i, t, *_ in rows:
            ids = library.encode_ordinary(t or "")
            want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), (t or "").encode()))
        assert sorted(((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), bytes(r.decoded)) for r in got), key=str) == sorted(want, key=str)


def test_frequent_words_are_bounded(spark):
    df = docs_frame(spark, [(k, "alpha beta beta " * (k + 4)) for k in range(5)])
    assert 0 < bpe.frequent_words(df, RANKS, P.PATTERN, frequent=2).count() <= 2


def test_empty_table(spark):
    assert bpe.round_trip(docs_frame(spark, []), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0
