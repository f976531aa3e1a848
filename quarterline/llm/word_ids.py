"""Token ids of whole texts by a lower-case word BPE file of the tokenizers library.

The library encodes each distinct piece once while it is remembered; texts are cut into pieces and put
together from remembered ids with array operations over whole stretches of text, so the cost of a word
that was seen before is that of finding its bounds.

* Texts are cut at ASCII white space into chunks. The library's result for a text is the concatenation of
  its results for the chunks, as its pieces never span white space and drop it.
* A plain chunk (ASCII letters, digits and marks without apostrophe, and the letters U+00C0 to U+00FF) is
  lowered and cut further into runs of letters, single digits and runs of marks, as the file's pattern does.
* Any other chunk (other scripts, combining marks, apostrophes, control characters, the strings of special
  tokens) is handed to the library whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut at a time.
STRETCH = 2 << 20
_SPACE, _LETTER, _DIGIT, _MARK, _HARD = range(5)


def _byte_classes() -> np.ndarray:
    kind = np.full(256, _HARD, np.uint8)
    for b in range(0x21, 0x7F):
        kind[b] = _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _MARK
    kind[ord("'")] = _HARD
    kind[[ord(c) for c in " \t\n\x0b\x0c\r"]] = _SPACE
    return kind


_KIND = _byte_classes()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|(?:(?!<\|)[!-&(-/:-@\[-`{-~])+")


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array (null: empty) and the len + 1 bounds of its texts in them."""
    if arr.null_count:
        arr = arr.fill_null("")
    if not pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    _, bounds, data = arr.buffers()
    ends = np.frombuffer(bounds, np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def stretches(data: np.ndarray, ends: np.ndarray, size: int = STRETCH):
    """Bounds of stretches of about ``size`` bytes that end at white space or at the end of a text."""
    at, total = 0, len(data)
    while at < total:
        stop = at + size
        if stop < total:
            text_end = int(ends[np.searchsorted(ends, stop)])
            while stop < text_end:
                space = np.flatnonzero(_KIND[data[stop:min(stop + (1 << 16), text_end)]] == _SPACE)
                if len(space):
                    stop += int(space[0])
                    break
                stop = min(stop + (1 << 16), text_end)
        stop = min(stop, total)
        yield at, stop
        at = stop


def cut_pieces(data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, lowered bytes) of the pieces of a stretch; ``text_starts`` are places where a text begins."""
    kind = _KIND[data]
    c3 = np.flatnonzero(data == 0xC3)
    c3 = c3[c3 + 1 < len(data)]
    second = data[c3 + 1]
    ok = (second != 0x97) & (second != 0xB7)
    c3, second = c3[ok], second[ok]
    kind[c3] = kind[c3 + 1] = _LETTER
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    kind[special] = _HARD
    text = kind != _SPACE
    fresh = np.zeros(len(data) + 1, bool)  # a chunk cannot go on here
    fresh[text_starts] = True
    fresh[0] = fresh[-1] = True
    begins = text.copy()
    begins[1:] &= ~text[:-1] | fresh[1:-1]
    chunk_start = np.flatnonzero(begins)
    low = _LOWER[data]
    upper = c3[(second >= 0x80) & (second <= 0x9E)] + 1
    low[upper] += 32
    hard = np.flatnonzero(kind == _HARD)
    split = begins
    split[1:] |= text[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    if len(hard):  # chunks with a hard byte stay whole, as they are
        which = np.unique(np.searchsorted(chunk_start, hard, "right") - 1)
        for w in which.tolist():
            a = int(chunk_start[w])
            b = int(chunk_start[w + 1]) if w + 1 < len(chunk_start) else len(data)
            split[a + 1:b] = False
            low[a:b] = data[a:b]
    starts = np.flatnonzero(split)
    is_end = text.copy()
    is_end[:-1] &= ~text[1:] | fresh[1:-1] | split[1:]
    return starts, np.flatnonzero(is_end) + 1, low


class WordEncoder:
    """Encodes with a tokenizers file, as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``.

    Valid for lower-case word BPE files with the pattern above. Two generations of at most ``cap`` pieces
    bound the memory; pieces that occur again move to the young one.
    """

    def __init__(self, path: str, cap: int = 300_000, stretch: int = STRETCH):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.cap, self.stretch = cap, stretch
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        vocab = self.tok.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Plain pieces are one word each, and a word's last id closes it: they are encoded many at a time
        and cut there. The others go one by one."""
        plain, other = [], []
        for p in pieces:
            (plain if _PLAIN.fullmatch(p) else other).append(p)
        lots = [plain[k:k + 256] for k in range(0, len(plain), 256)]
        for lot, ids in zip(lots, self._ids([b" ".join(x).decode() for x in lots])):
            cut = np.flatnonzero(self.closes[ids]) + 1
            if len(cut) != len(lot) or cut[-1] != len(ids):
                other += lot
                continue
            raw, cut = ids.tobytes(), (cut * self.width).tolist()
            self.young.update(zip(lot, map(raw.__getitem__, map(slice, [0, *cut[:-1]], cut))))
        for p, ids in zip(other, self._ids([p.decode() for p in other])):
            self.young[p] = ids.tobytes()

    def _known(self, pieces: list[bytes]) -> list[bytes]:
        found = list(map(self.young.get, pieces))
        if None in found:
            if len(self.young) > self.cap:
                self.old, self.young = self.young, {}
            new = []
            for p in pieces:
                if p not in self.young:
                    ids = self.old.get(p)
                    if ids is None:
                        new.append(p)
                    else:
                        self.young[p] = ids
            self._learn(new)
            found = list(map(self.young.__getitem__, pieces))
        return found

    def encode_array(self, arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text); null counts as empty."""
        data, ends = text_buffer(arr)
        counts, parts = np.zeros(len(arr), np.int64), [np.zeros(0, self.dtype)]
        for a, b in stretches(data, ends, self.stretch):
            inside = ends[np.searchsorted(ends, a):np.searchsorted(ends, b)] - a
            starts, stops, low = cut_pieces(data[a:b], inside)
            if not len(starts):
                continue
            size = stops - starts
            bounds = np.zeros(len(size) + 1, np.int32)
            np.cumsum(size, out=bounds[1:])
            body = low[_KIND[data[a:b]] != _SPACE]
            words = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(body)])
            coded = words.dictionary_encode()
            ids = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            flat = np.frombuffer(b"".join(ids), self.dtype)
            n_of = np.fromiter(map(len, ids), np.int64, len(ids)) // self.width
            at = np.cumsum(n_of) - n_of
            which = coded.indices.to_numpy()
            n = n_of[which]
            out_at = np.cumsum(n) - n
            take = np.repeat(at[which] - out_at, n)
            take += np.arange(len(take))
            parts.append(flat[take])
            text_of = np.searchsorted(ends, starts + a, "right") - 1
            counts += np.bincount(text_of, weights=n, minlength=len(arr)).astype(np.int64)
        return np.concatenate(parts), counts

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text in little-endian bytes."""
        ids, counts = self.encode_array(pa.array(texts, pa.large_string()))
        ends = np.cumsum(counts)
        return [ids[e - n:e].tobytes() for e, n in zip(ends.tolist(), counts.tolist())]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
