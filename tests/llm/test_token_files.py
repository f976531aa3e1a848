import zlib

import numpy as np
import pytest

from quarterline.llm.token_files import read_token_files, write_token_files
from quarterline.llm.word_ids import WordEncoder, word_encoder
from doc_helpers import docs_frame, odd_rows

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
HARD = ["École, ÉCOLE. İstanbul; ΣΑΣ! don't x's A.B., a,,b (x) été. İı? \x1c a\x1db c\x85d <|endoftext|> ½.",
        "ǅ. ŉ, ẞ! ſ ﬁ. ﬁx", "", " \n", "1,2,3. 10%", "a <|endoftext|> b <|startoftext|>x<|ENDOFTEXT|> <| |> <|<|endoftext|>",
        "ÀÖ×Øß÷Þþÿ ÃÃ é\u0301 e\u0301 \u0301a \xa0 \u2028x n'T 'S'S ''re \x00 \x7f \ufffd", "x" * 5000 + "," * 300 + "7" * 50]


def reference(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("cap, stretch", [(1, 997), (3, 5000), (100_000, 1 << 20)])
def test_encoder_equals_the_library(cap, stretch):
    texts = HARD + [t or "" for _, t, *_ in odd_rows()]
    enc = WordEncoder(PATH, cap=cap, stretch=stretch)
    for _ in range(2):
        assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == reference(texts)


def test_files_round_trip(spark):
    rows = odd_rows() + [(20 + k, t) for k, t in enumerate(HARD)] + [(-5, "negative id"), (10**15, "large id")]
    files = write_token_files(docs_frame(spark, rows, extra=True), lambda: word_encoder(PATH))
    got = read_token_files(files).orderBy("start").collect()
    want = {(i, t): np.array(x + [1], "<u4") for (i, t, *_), x in zip(rows, reference([t or "" for _, t, *_ in rows]))}
    assert [r.doc_id is not None for r in got] == sorted(r.doc_id is not None for r in got)  # null ids first
    order = [r.doc_id for r in got if r.doc_id is not None]
    assert order == sorted(order) and len(got) == len(rows)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert (sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str)
            == sorted(((i, len(x), zlib.crc32(x.tobytes())) for i, t, *_ in rows for x in [want[i, t]]), key=str))


def test_empty_table(spark):
    assert read_token_files(write_token_files(docs_frame(spark, []), lambda: word_encoder(PATH))).count() == 0
