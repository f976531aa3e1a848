import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from doc_helpers import docs_frame, odd_rows

from quarterline.llm.packing import (best_fit, crossed, document_pieces, evolved, pack_documents, pack_lengths, packed_by_best_fit,
                                     sequences)
from quarterline.llm.word_ids import word_encoder

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return lambda: word_encoder(PATH)


def reference(texts, end_id=0):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    return [[*e.ids, end_id] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def plain_best_fit(lengths, capacity):
    room, out = [], []
    for n in lengths:
        fit = [(r, b) for b, r in enumerate(room) if r >= n]
        if fit:
            out.append(min(fit)[0])
            b = min(fit)[1]
            room[b] -= n
        else:
            room.append(capacity - n)
            out.append(capacity)
    return sorted(room), out


def test_best_fit_takes_the_least_room_that_fits():
    r = np.random.default_rng(1)
    for k in range(20):
        lengths = r.integers(1, 101, 200).tolist()
        fills = []
        bins = best_fit(lengths, fills, 100)
        assert sorted(100 - f for f in fills) == plain_best_fit(lengths, 100)[0]
        assert np.bincount(bins, weights=lengths).tolist() == fills


def test_children_are_packings_and_populations_only_improve():
    r = np.random.default_rng(2)
    lengths = np.sort(r.integers(200, 500, 600))
    start = packed_by_best_fit(lengths, np.argsort(-lengths, kind="stable"), 1000)
    other = packed_by_best_fit(lengths, r.permutation(600), 1000)
    for k in range(30):
        child = crossed(start, other, lengths, 1000, r, 0.5, 0.3)
        assert len(child.bin_of) == 600 and child.fills.max() <= 1000 and child.fills.min() > 0
        assert np.array_equal(np.bincount(child.bin_of, weights=lengths).astype(int), child.fills)
    before = evolved(lengths, [], 1000, np.random.default_rng(3), 5, 0)[0]
    after = evolved(lengths, [], 1000, np.random.default_rng(3), 5, 300)[0]
    assert after.rank < before.rank and before.rank <= start.rank


def whole_bins(b, a, lengths, capacity):
    return {tuple(np.flatnonzero(b.bin_of == k)) for k in range(len(b.fills)) if b.fills[k] >= 0.995 * capacity}


def test_well_filled_bins_are_injected_whole():
    r = np.random.default_rng(4)
    lengths = np.sort(r.integers(50, 500, 300))
    a = packed_by_best_fit(lengths, r.permutation(300), 1000)
    b = packed_by_best_fit(lengths, np.argsort(-lengths, kind="stable"), 1000)
    child = crossed(a, b, lengths, 1000, r, 1.0, 0.0)
    assert whole_bins(b, a, lengths, 1000) <= {tuple(np.flatnonzero(child.bin_of == k)) for k in range(len(child.fills))}


def items_frame(spark, lengths):
    return spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "uid long, length long")


def check_places(rows, lengths, capacity):
    assert sorted(r.uid for r in rows) == list(range(len(lengths)))
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, int(lengths[r.uid])))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts[:-1]]]).tolist()
        assert sum(n for _, n in parts) <= capacity
    return len(by)


@pytest.mark.parametrize("kind", ["mixed", "equal", "large", "one", "full"])
def test_sequences_hold_no_more_than_fits_and_few_are_needed(spark, kind):
    r = np.random.default_rng(5)
    lengths = {"mixed": np.minimum(2048, r.lognormal(6.2, 0.9, 3000).astype(int) + 1), "equal": np.full(900, 1000),
               "large": r.integers(1025, 2048, 500), "one": np.array([7]), "full": np.full(40, 2048)}[kind]
    n = check_places(pack_lengths(items_frame(spark, lengths), shard=500).collect(), lengths, 2048)
    least = {"equal": 450, "large": 500, "full": 40}.get(kind, -(-int(lengths.sum()) // 2048))
    assert least <= n <= least + (2 if kind == "mixed" else 0)


def test_islands_beat_plain_best_fit_where_it_is_weak(spark):
    """Lengths of which three fill a bin: best fit on falling lengths wastes room there."""
    r = np.random.default_rng(6)
    a = r.integers(380, 491, 150)
    b = r.integers(260, 1000 - a - 250)
    lengths = np.concatenate([a, b, 1000 - a - b])
    plain = len(packed_by_best_fit(lengths, np.argsort(-lengths, kind="stable"), 1000).fills)
    rows = pack_lengths(items_frame(spark, lengths), capacity=1000, children=150).collect()
    assert 150 <= check_places(rows, lengths, 1000) < plain


def test_reruns_agree(spark):
    lengths = np.random.default_rng(7).integers(1, 2048, 800)
    a, b = (sorted(map(tuple, pack_lengths(items_frame(spark, lengths).repartition(k), shard=200).collect())) for k in (1, 5))
    assert a == b


def test_documents_round_trip(spark, encoder):
    rows = odd_rows() + [(20, "a <|endoftext|> b"), (21, "word " * 2047), (22, "word " * 2048), (23, "word " * 4095)]
    docs = docs_frame(spark, rows, extra=True)
    packed = pack_documents(docs, encoder)
    got = packed.collect()
    want = Counter()
    for (i, *_), ids in zip(rows, reference([t for _, t, *_ in rows])):
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k:k + 2048], "<u4").tobytes()
            want[i, k // 2048, k, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(r.ids)) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for s in sequences(packed).collect():
        parts = sorted(by[s.sequence_id])
        assert bytes(s.ids) == b"".join(p[2] for p in parts) and s.length == sum(p[1] for p in parts) <= 2048
        assert [(p.offset, p.length) for p in s.pieces] == [p[:2] for p in parts]
        assert [o for o, _, _ in parts] == np.cumsum([0, *[n for _, n, _ in parts[:-1]]]).tolist()


def test_empty_table_and_empty_texts(spark, encoder):
    assert pack_documents(docs_frame(spark, []), encoder).count() == 0
    got = pack_documents(docs_frame(spark, [(1, None), (2, ""), (None, " ")]), encoder).collect()
    assert len({r.sequence_id for r in got}) == 1 and sorted(r.offset for r in got) == [0, 1, 2]
    assert document_pieces(docs_frame(spark, [(1, "")]), encoder).first().ids == bytearray(b"\0\0\0\0")
