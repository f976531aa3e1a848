"""Secret scans: pattern spans, and a character convolutional network over every candidate.

Base spans come from three patterns and always stay. Candidates are all runs of 12 or more secret-like
characters that overlap no base span and hold a digit, one of + / _ =, a capital after their first
character, or 20 characters: all but plain words. A window is 24 characters before its start, 40
characters of the run and 8 after them. A run is seen through windows that start every 20 characters and
after each = that leaves 6 or more characters, so no part goes unseen; the highest score counts. Training
uses one window of each finding, the first of a base value and one by hash of a candidate.
The network embeds characters, convolves them (width 5), takes maxima over the candidate and over the
whole window, and scores the finding.

Training: base spans are positive, candidates unlabelled, as secrets without a pattern are among them.
A positive window starts at the value, like a candidate's. Every finding is seen in two views, with its
context and alone with blanks around it, so that keywords are not all that tells; its score is the highest
one over its windows and views. All findings are used, dealt by hash to shards that learn side by side and meet in
the mean of their weights after every pass; one finding in ``FOLDS`` is for calibration. First either half is scored
by a network trained on the other half and made findings; candidates that score like positive findings are left out of the training and
calibration of the final network (``ROUNDS`` times over, as each round sees more of them).

The base patterns know few alphabets and forms, so the networks also learn from made findings, put in
the place of a candidate: values of other alphabets, cases and lengths, with prefixes and separators
(``made_value``, ``VARIANTS`` per positive finding), as positive, and words of the candidates' surroundings
joined as paths, names, hosts and dates are (``made_plain``), as the other label. Calibration and threshold
are set on what is judged, the highest score of a finding, real and made: a logistic regression, then the
largest threshold that still finds ``recall`` of the positive ones. Every finding is scored; candidates that
reach the threshold are added as spans of kind ``cnn``.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm.common import text_or_empty, written

# The base patterns and their least lengths; kinds in the order in which spans are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # AKIA[A-Z0-9]+ of 20 or more characters
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ["assign", "access", "hex", "cnn"]

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_DIGIT = re.compile(r"[0-9]")
_KEYLIKE = re.compile(r"[+/_=]|.[A-Z]")
_VALUE = re.compile(r"=(?=[^=]{6})")
_PLAIN_WORD = re.compile(r"\b[A-Za-z][a-z]{2,8}\b", re.A)
BEFORE, BODY, AFTER = 24, 40, 8
LONG, STEP = 20, 20
FOLDS, ROUNDS, RECALL = 5, 3, 0.97
#: Findings of a shard, and of either label in it at least; passes over the findings if there are several shards.
SHARD_FINDINGS, LEAST_OF_LABEL, PASSES = 6_000, 150, 4
LINES = 1_024
VARIANTS = 2
#: Characters of a finding that the training may carry; the scoring sees every run whole.
TEACH_CHARS = 2_000
FILTERS, WIDTH, EMBED, EPOCHS, BATCH = 16, 5, 8, 12, 32

_SPAN = "array<struct<kind:int,start:int,end:int,window:string,stretch:string,lead:int,size:int>>"
_SPAN_T = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("window", pa.string()),
                              ("stretch", pa.string()), ("lead", pa.int32()), ("size", pa.int32())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    spans = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    spans += [(1, *m.span()) for m in ACCESS.finditer(text)]
    spans += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def candidate_spans(text: str, base: list[tuple[int, int, int]], gate=_DIGIT.search) -> list[tuple[int, int, int]]:
    """Secret-like runs that pass the gate (hold a digit) and overlap no base span."""
    out, k, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        if gate(m[0]):
            while k < len(base) and base[k][1] < m.end():
                reach = max(reach, base[k][2])
                k += 1
            if reach <= m.start():
                out.append((3, *m.span()))
    return out


def no_plain_word(run: str) -> bool:
    """The gate of the scan: secrets without a digit pass, too."""
    return len(run) >= LONG or bool(_DIGIT.search(run) or _KEYLIKE.search(run))


def window_starts(text: str, start: int, end: int) -> list[int]:
    """Starts of windows whose bodies cover the run, and of values in it."""
    grid = range(start, max(start, end - BODY + STEP - 1) + 1, STEP)
    return sorted({*grid, *(m.end() for m in _VALUE.finditer(text, start, end))})


def window(text: str, start: int, end: int) -> str:
    """Context and candidate as BEFORE + BODY + AFTER characters, blanks where there is no text."""
    cut = min(end, start + BODY)
    return (text[max(0, start - BEFORE):start].rjust(BEFORE) + text[start:cut].ljust(BODY)
            + text[cut:cut + AFTER].ljust(AFTER))


def value_start(text: str, kind: int, start: int) -> int:
    """Where the value of a base span starts."""
    return ASSIGN.match(text, start).start(2) if kind == 0 else start


def alone(w: str) -> str:
    """A window without its context."""
    return " " * BEFORE + w[BEFORE:BEFORE + BODY] + " " * AFTER


def shorter(w: str) -> str:
    """A window whose body is cut to a length between that of the shortest candidate and BODY, by hash."""
    return w[:BEFORE] + w[BEFORE:BEFORE + 12 + zlib.crc32(w.encode("utf-8", "replace")) % (BODY - 11)].ljust(BODY) + w[BEFORE + BODY:]


_UPPER, _LOWER, _TEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABETS = [_TEN + "abcdef", _TEN + "abcdef", _TEN + "ABCDEF", _UPPER + _LOWER + _TEN, _UPPER + _LOWER + _TEN, _UPPER + _LOWER + _TEN + "+/",
              _UPPER + _LOWER + _TEN + "-_", _UPPER + _TEN, _LOWER + _TEN, _UPPER + _LOWER]


def made_value(r: random.Random) -> str:
    """A random value: any of the alphabets, 12 to 60 characters, now and then in parts, with a prefix or filled up."""
    alphabet, n = r.choice(_ALPHABETS), r.randint(12, 60)
    body = "".join(r.choice(alphabet) for _ in range(n))
    if r.random() < 0.4:
        cuts = sorted(r.sample(range(4, n - 3), r.randint(1, n // 8)))
        body = r.choice("--._").join(body[a:b] for a, b in zip([0, *cuts], [*cuts, n]))
    if r.random() < 0.3:
        body = "".join(r.choice(_LOWER) for _ in range(r.randint(2, 5))) + r.choice("_-_.") + body
    return body + "=" * r.randint(1, 2) if r.random() < 0.1 else body


def made_plain(r: random.Random, words: list[str]) -> str:
    """A run that is no secret: words as in a path, a name, a host or a sentence without blanks, or numbers as in a date,
    a version, an address or a serial number."""
    some = r.sample(words, min(len(words), r.randint(2, 4)))
    number = lambda n: "".join(r.choice(_TEN) for _ in range(n))
    form = r.randrange(8)
    if form < 5:
        run = ["/" + "/".join(some), "_".join(some), "-".join(some), ".".join([*some, "com"]), "".join(w.capitalize() for w in some)][form]
        run += r.choice(["", "", "." + number(2), "=" + number(3), "-" + number(1)])
    else:
        run = [f"20{number(2)}-{number(2)}-{number(2)}", ".".join(number(r.randint(1, 3)) for _ in range(4)), number(r.randint(12, 20))][form - 5]
    return run if len(run) >= 12 else run + "-" + r.choice(words) * 3


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): base spans and candidates, each with the window to learn from and the stretch of text
    around it, in which the run or value takes ``size`` characters from ``lead`` on; one row per document."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b["text"]:
                text = t.as_py()
                base = base_spans(text)
                spans = []
                for k, s, e in base + candidate_spans(text, base, no_plain_word):
                    at = value_start(text, k, s) if k < 3 else s
                    lo = max(0, at - BEFORE)
                    teach = at
                    if k == 3:
                        starts = window_starts(text, s, e)
                        teach = starts[zlib.crc32(text[s:e].encode()) % len(starts)]
                    spans.append({"kind": k, "start": s, "end": e, "window": window(text, teach, e),
                                  "stretch": text[lo:e + AFTER], "lead": at - lo, "size": e - at})
                out.append(spans)
            yield pa.record_batch([b["doc_id"], pa.array(out, _SPAN_T)], names=["doc_id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(scan, f"doc_id long, spans {_SPAN}")


class CharCNN:
    """Embedding, convolution, ReLU, maxima over two zones, logistic output; trained with Adam in numpy."""

    def __init__(self, seed: int = 0):
        r = np.random.default_rng(seed)
        self.p = {"embed": r.normal(0, 0.5, (129, EMBED)), "conv": r.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)),
                  "shift": np.zeros(FILTERS), "out": r.normal(0, 0.3, 2 * FILTERS), "bias": np.zeros(1)}
        self.scale, self.offset, self.threshold = 1.0, 0.0, 0.5

    @staticmethod
    def codes(windows: list[str]) -> np.ndarray:
        """Character codes; all beyond ASCII share one."""
        raw = np.frombuffer("".join(windows).encode("utf-32-le"), "<u4").reshape(len(windows), BEFORE + BODY + AFTER)
        return np.minimum(raw, 128).astype(np.int64)

    def _forward(self, x: np.ndarray):
        e = self.p["embed"][x]
        n = x.shape[1] - WIDTH + 1
        cols = np.concatenate([e[:, k:k + n] for k in range(WIDTH)], axis=2)
        h = np.maximum(cols @ self.p["conv"] + self.p["shift"], 0)
        body = h[:, BEFORE:BEFORE + BODY - WIDTH + 1]
        at_body, at_all = body.argmax(1) + BEFORE, h.argmax(1)
        top = np.concatenate([np.take_along_axis(h, at_body[:, None], 1)[:, 0], np.take_along_axis(h, at_all[:, None], 1)[:, 0]], 1)
        return cols, h, at_body, at_all, top, top @ self.p["out"] + self.p["bias"][0]

    def margins(self, windows: list[str]) -> np.ndarray:
        parts = [self._forward(self.codes(windows[i:i + 512]))[-1] for i in range(0, len(windows), 512)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def scores(self, windows: list[str]) -> np.ndarray:
        return self._score(self.margins(windows))

    def _score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * margins + self.offset, -500, 500)))

    def highest_margins(self, spans: list[dict]) -> np.ndarray:
        """The highest margin among the windows of each finding, in both views; a few thousand windows at a time."""
        out, lot, owner = np.full(len(spans), -np.inf), [], []
        both = lambda w: np.maximum(self.margins(w), self.margins([alone(x) for x in w]))
        for k, s in enumerate(spans):
            end = s["lead"] + s["size"]
            for at in window_starts(s["stretch"], s["lead"], end):
                lot.append(window(s["stretch"], at, end))
                owner.append(k)
                if len(lot) == 4096:
                    np.maximum.at(out, owner, both(lot))
                    lot, owner = [], []
        if lot:
            np.maximum.at(out, owner, both(lot))
        return out

    def highest(self, spans: list[dict]) -> np.ndarray:
        """The score of each finding: that of its highest margin."""
        return self._score(self.highest_margins(spans))

    def train(self, windows: list[str], y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 1) -> None:
        x, r = self.codes(windows), np.random.default_rng(seed)
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(y))
            for lo in range(0, len(y), BATCH):
                i = order[lo:lo + BATCH]
                g = self._gradients(x[i], y[i], share[i])
                step += 1
                for k in self.p:
                    m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                    m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                    self.p[k] -= rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)

    def _gradients(self, x: np.ndarray, y: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        cols, h, at_body, at_all, top, z = self._forward(x)
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share / len(y)
        dtop = dz[:, None] * self.p["out"]
        dh = np.zeros_like(h)
        rows, f = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        np.add.at(dh, (rows, at_body, f), dtop[:, :FILTERS])
        np.add.at(dh, (rows, at_all, f), dtop[:, FILTERS:])
        dh *= h > 0
        dcols = dh @ self.p["conv"].T
        de = np.zeros((*x.shape, EMBED))
        for k in range(WIDTH):
            de[:, k:k + h.shape[1]] += dcols[:, :, k * EMBED:(k + 1) * EMBED]
        embed = np.zeros_like(self.p["embed"])
        np.add.at(embed, x, de)
        return {"embed": embed, "conv": np.tensordot(cols, dh, ((0, 1), (0, 1))), "shift": dh.sum((0, 1)),
                "out": top.T @ dz, "bias": np.array([dz.sum()])}

    def calibrate(self, windows: list[str], y: np.ndarray, recall: float = RECALL) -> None:
        self.settle(self.margins(windows), y, recall)

    def settle(self, m: np.ndarray, y: np.ndarray, recall: float = RECALL, n: np.ndarray | None = None) -> None:
        """Logistic regression of the label on the margin, held by ``n`` findings each; then the largest threshold with ``recall``."""
        n = np.ones(len(m), np.int64) if n is None else n
        pos, neg = n[y == 1].sum(), n[y == 0].sum()
        t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
        a = np.stack([m, np.ones(len(m))], 1)
        b = np.array([1.0, 0.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            b = b + np.clip(np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (n * (t - p))), -1, 1)
        if b[0] > 0:
            self.scale, self.offset = float(b[0]), float(b[1])
        order = np.argsort(m[y == 1], kind="stable")
        self.threshold = float(self._score(np.array([_least(m[y == 1][order], n[y == 1][order], recall)]))[0])


def _settings(pdf: list[dict]) -> tuple[np.ndarray, list[str], list[dict]]:
    """Labels, windows and spans of a shard's findings; of long ones the window stands for the whole."""
    spans = [{"stretch": r["stretch"] or r["window"], "lead": r["lead"] if r["stretch"] else BEFORE,
              "size": r["size"] if r["stretch"] else BODY} for r in pdf]
    return np.array([r["label"] for r in pdf], np.int64), [r["window"] for r in pdf], spans


def _shard_rows(t: pa.Table) -> list[dict]:
    return sorted(t.to_pylist(), key=lambda r: (r["order"], r["label"], r["window"]))


def _made(y: np.ndarray, spans: list[dict], each: int, seed: int) -> tuple[list[dict], list[int]]:
    """Made values and plain runs in the places of the candidates."""
    r = random.Random(seed)  # fixed: reruns agree
    places = [s for s, label in zip(spans, y) if not label]
    words = sorted({x for s in spans for x in _PLAIN_WORD.findall(s["stretch"][:s["lead"]] + " " + s["stretch"][s["lead"] + s["size"]:])})
    out, labels = [], []
    for label in ((1, 0) if words else (1,)) if places else ():
        for _ in range(each * int(y.sum())):
            s, run = r.choice(places), made_value(r) if label else made_plain(r, words)
            out.append({"stretch": s["stretch"][:s["lead"]] + run + s["stretch"][s["lead"] + s["size"]:], "lead": s["lead"], "size": len(run)})
            labels.append(label)
    return out, labels


def _made_windows(spans: list[dict]) -> list[str]:
    return [window(s["stretch"], s["lead"], s["lead"] + s["size"]) for s in spans]


def _bare(w: list[str], y: np.ndarray) -> list[str]:
    return [alone(shorter(x) if label else x) for x, label in zip(w, y)]


def taught(rows: DataFrame, shards: int, key: str) -> dict[int, CharCNN]:
    """One network for each value of ``key``, from all of its findings, real and made.

    Every shard goes on from the same network, one pass over its findings at a time, and the mean of the shards'
    weights is the next one; a single shard makes all ``EPOCHS`` passes at once. Means are of decimals, so the
    order of the sum does not matter and reruns agree."""
    nets: dict[int, CharCNN] = {}
    passes, epochs = (1, EPOCHS) if shards == 1 else (PASSES, 1)
    names = list(CharCNN().p)
    for k in range(passes):
        shared = rows.sparkSession.sparkContext.broadcast(nets)  # a few thousand numbers each

        def learn(group: tuple, t: pa.Table) -> pa.Table:
            own, shard = (x.as_py() for x in group)
            y, w, spans = _settings(_shard_rows(t))
            extra, labels = _made(y, spans, VARIANTS, 7 + shard)
            seen = _made_windows(extra)
            net = shared.value.get(own) or CharCNN()
            net.train([*w, *_bare(w, y), *seen, *[alone(x) for x in seen]],
                      np.concatenate([y, y, labels, labels]).astype(int), epochs, seed=1 + k)
            flat = np.concatenate([net.p[x].ravel() for x in names])
            return pa.table({"own": pa.array([own] * len(flat), pa.int32()), "at": pa.array(range(len(flat)), pa.int32()), "x": flat})

        got = (rows.withColumn("own", F.col(key).cast("int")).repartition(2 * shards, "own", "shard").groupBy("own", "shard")
               .applyInArrow(learn, "own int, at int, x double")
               .groupBy("own", "at").agg(F.sum(F.col("x").cast("decimal(28,14)")).alias("x"), F.count(F.lit(1)).alias("n")).collect())
        nets = {}
        for own in {r.own for r in got}:  # one row for each weight of a network
            flat = np.array([float(r.x) / r.n for r in sorted((r for r in got if r.own == own), key=lambda r: r.at)])
            nets[own] = net = CharCNN()
            at = 0
            for x in names:
                net.p[x] = flat[at:at + net.p[x].size].reshape(net.p[x].shape)
                at += net.p[x].size
    return nets


def _lines(margins: DataFrame, *keys: str) -> list:
    """(keys, m, n): how many margins lie on each line, 1 / LINES apart; as many rows as lines, however many findings."""
    return (margins.withColumn("m", F.floor(F.col("m") * LINES) / LINES).groupBy(*keys, "m")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(*keys, "m").collect())


def _least(m: np.ndarray, n: np.ndarray, recall: float) -> float:
    """The largest of the ascending values, held by n findings each, that ``recall`` of the findings reach."""
    return float(m[np.searchsorted(np.cumsum(n), int((1 - recall) * n.sum()), side="right")])


def dealt(found: DataFrame) -> tuple[DataFrame, int]:
    """All findings, dealt to shards of about ``SHARD_FINDINGS`` by hash, and the number of shards. Of a label with few
    findings each goes to several shards, ``copy`` 0, 1, ..., so that every shard has both."""
    each = (found.select("doc_id", F.explode("spans").alias("s"))
            .select((F.col("s.kind") < 3).cast("int").alias("label"), F.col("s.window").alias("window"),
                    F.when(F.length("s.stretch") <= TEACH_CHARS, F.col("s.stretch")).alias("stretch"), F.col("s.lead").alias("lead"),
                    F.col("s.size").alias("size"), F.xxhash64("doc_id", "s.start", "s.kind").alias("order")))
    n = {r.label: r.n for r in each.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = max(1, round(sum(n.values()) / SHARD_FINDINGS))
    copies = {k: min(shards, -(-LEAST_OF_LABEL * shards // max(1, n.get(k, 0)))) for k in (0, 1)}
    each = (each.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, copies[1] - 1).otherwise(copies[0] - 1))))
            .withColumn("shard", (F.pmod(F.xxhash64("order", F.lit("shard")) + F.col("copy"), F.lit(shards))).cast("int"))
            .withColumn("half", F.pmod(F.xxhash64("order", F.lit("half")), F.lit(2)).cast("int"))
            .withColumn("fold", F.pmod(F.xxhash64("order", F.lit("fold")), F.lit(FOLDS)) == 0))
    return written(each, "secret-dealt"), shards


def _both(rows: DataFrame, *keys: str) -> int:
    """The number of values of the keys under which both labels occur."""
    return rows.groupBy(*keys).agg(F.count_distinct("label").alias("k")).filter("k = 2").count()


def fit(found: DataFrame, recall: float = RECALL) -> CharCNN | None:
    """A network from all findings; None if one label is missing."""
    rows, shards = dealt(found)
    if not _both(rows.withColumn("all", F.lit(1)), "all"):
        return None
    if _both(rows, "fold") < 2:
        learn = settle = F.lit(True)  # too few findings for two folds: train and calibrate on all
    else:
        learn, settle = ~F.col("fold"), F.col("fold")
    rows = _unlike(rows, shards, recall)
    sure = rows.filter("label = 1 or out")
    if not all(_both(sure.filter(m).withColumn("all", F.lit(1)), "all") for m in (learn, settle)):
        sure = rows
    net = taught(sure.filter(learn).withColumn("one", F.lit(0)), shards, "one")[0]
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def seen(group: tuple, t: pa.Table) -> pa.Table:
        some = _shard_rows(t)
        y, _, spans = _settings(some)
        extra, labels = _made(y, spans, 1, 107 + group[0].as_py())
        first = np.array([r["copy"] == 0 for r in some] + [True] * len(extra), bool)
        return pa.table({"label": np.append(y, labels).astype(np.int32)[first],
                         "m": shared.value.highest_margins(spans + extra)[first].astype(float)})

    lines = _lines(sure.filter(settle).repartition(2 * shards, "shard").groupBy("shard").applyInArrow(seen, "label int, m double"), "label")
    net.settle(np.array([r.m for r in lines]), np.array([r.label for r in lines]), recall, np.array([r.n for r in lines]))
    return net


def _unlike(rows: DataFrame, shards: int, recall: float) -> DataFrame:
    """The findings with ``out``: seen alone, they score below ``recall`` of the positive ones, real and made, by a
    network not trained on them."""
    rows = rows.withColumn("out", F.lit(True))
    cols = rows.columns
    kind = ", ".join(f"{c} {t}" for c, t in [*rows.dtypes, ("m", "double"), ("made", "boolean")])
    for k in range(ROUNDS):  # candidates left out before do not teach the networks that judge the others
        use = rows.filter("out or label = 1")
        if _both(use, "half") < 2:
            break
        nets = rows.sparkSession.sparkContext.broadcast(taught(use, shards, "half"))

        def judge(group: tuple, t: pa.Table) -> pa.Table:
            half, shard = (x.as_py() for x in group)
            net, some = nets.value[1 - half], _shard_rows(t)
            y, w, spans = _settings(some)
            used = np.array([r["out"] or r["label"] == 1 for r in some], bool)
            extra, labels = _made(y[used], [s for s, ok in zip(spans, used) if ok], 1, 57 + shard)
            some += [{**{c: None for c in cols}, "half": half, "copy": 0, "label": 1, "made": True} for x in labels if x]
            m = net.margins(_bare(w, y) + [alone(x) for x, label in zip(_made_windows(extra), labels) if label])
            return pa.Table.from_pylist([{"made": False, **r, "m": float(x)} for r, x in zip(some, m)],
                                        schema=pa.schema([*t.schema, ("m", pa.float64()), ("made", pa.bool_())]))

        judged = written(rows.repartition(2 * shards, "half", "shard").groupBy("half", "shard").applyInArrow(judge, kind), f"secret-judged-{k}")
        lines = _lines(judged.filter("label = 1 and copy = 0"), "half")
        cut = {}
        for half in (0, 1):
            own = [r for r in lines if r.half == half]
            cut[half] = _least(np.array([r.m for r in own]), np.array([r.n for r in own]), recall)
        rows = judged.filter("not made").withColumn("out", F.col("m") < F.when(F.col("half") == 0, cut[0]).otherwise(cut[1])).select(*cols)
    return rows


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, base (array of kind, start, end), added (the same, with score).

    Null text counts as empty and has no spans; an empty table gives an empty result; other columns are not looked at. Rows that repeat are scanned alike. If the table holds
    no base span or no candidate, there is nothing to learn from: nothing is added, base spans score 1.
    """
    found = written(findings(docs, id_col, text_col), "secret-findings")
    net = fit(found)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand numbers

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for b in batches:
            rows = b["spans"].to_pylist()
            flat = [s for r in rows for s in r]
            scores = net.highest(flat) if net else [float(s["kind"] < 3) for s in flat]
            for f, score in zip(flat, scores):
                f["score"] = float(score)
            least = net.threshold if net else 1.0
            base = [[s for s in r if s["kind"] < 3] for r in rows]
            added = [[s for s in r if s["kind"] == 3 and s["score"] >= least] for r in rows]
            yield pa.record_batch([b["doc_id"], pa.array(base, span), pa.array(added, span)], names=["doc_id", "base", "added"])

    kind = "array<struct<kind:int,start:int,end:int,score:double>>"
    return found.mapInArrow(judge, f"doc_id long, base {kind}, added {kind}")


def span_column(spans):
    """Spans of a column of ``secret_scan`` as kind:start:end, by start, then kind, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
