import random
import re

import numpy as np

from quarterline.llm import secrets as sec
from doc_helpers import docs_frame, odd_rows

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
HARD = ["token=token:abcdefgh", "password==abc123", "secret: 'x' token = \"abcdef\"", "AKIA", "AKIA" + "A" * 15, "AKIA" + "A" * 16,
        "xAKIAAKIA" + "B2" * 9 + "c", "deadbeef" * 3, "deadbeef" * 2 + "g", "é\U0001f600 api_key:ABCDEF0123456789abcdef0123 API-KEY", "ſecret=abcdef",
        "toKen=abcdef", "password=" + "0f" * 20_000, "token" + " " * 5000 + "=" + "abcdef"]


def brute(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, k, e in sorted(spans)]


def test_base_spans_equal_the_patterns_as_written():
    r = random.Random(1)
    bits = ["token", "secret", "=", ":", " ", "'", '"', "abc", "AKIA", "0f" * 9, "X9", "api_key", "\n", "é"]
    for t in HARD + ["".join(r.choice(bits) for _ in range(r.randint(1, 60))) for _ in range(2000)]:
        base = sec.base_spans(t)
        assert base == brute(t)
        for _, s, e in sec.candidate_spans(t, base):
            assert all(e <= x or s >= y for _, x, y in base) and any(c.isdigit() for c in t[s:e])
            assert len(sec.window(t, s, e)) == 72


def findings_corpus(n=300):
    r = random.Random(2)
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))
    rows = []
    for k in range(n):
        pad = " ".join(f"word{r.randrange(9)}x" for _ in range(10))
        rows.append((k, f"{pad} password={hexa(18)} {pad} mail{k}.{r.randrange(99)}@mail{k % 9}.example.com"))
    return rows + [(n, f"notes pwd={hexa(18)} end")]


def test_contract_and_added_spans(spark):
    rows = findings_corpus() + [(1000 + k, t) for k, t in enumerate(HARD)] + odd_rows()
    df = docs_frame(spark, rows, extra=True)
    got = sec.secret_scan(df).withColumn("text_spans", sec.span_column("base")).collect()
    want = sorted(((i, sec.span_text(brute(t or ""))) for i, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.text_spans) for r in got), key=str) == want
    again = sec.secret_scan(df).withColumn("text_spans", sec.span_column("base")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mails = sum(len(r.added) for r in got if r.doc_id is not None and r.doc_id < 300)
    assert mails < 30  # mail addresses are candidates of the other label


def test_network_learns_and_meets_its_recall():
    rows = findings_corpus()
    w, y = [], []
    for _, t in rows:
        base = sec.base_spans(t)
        for _, s, e in base + sec.candidate_spans(t, base):
            w.append(sec.window(t, s, e))
            y.append(int((s, e) in [b[1:] for b in base]))
    y = np.array(y)
    net = sec.CharCNN()
    x = net.codes(w[:8])
    g = net._gradients(x, y[:8], np.ones(8))
    loss = lambda: -np.mean(np.where(y[:8] == 1, 1, -1) * 0 + y[:8] * (z := net._forward(x)[-1]) - np.log1p(np.exp(z)))
    for name in ("conv", "out", "bias", "shift"):  # against finite differences
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old, h = net.p[name][at], 1e-5
        net.p[name][at] = old + h
        up = loss()
        net.p[name][at] = old - h
        down = loss()
        net.p[name][at] = old
        assert abs((up - down) / (2 * h) - g[name][at]) < 1e-5
    half = np.arange(len(y)) % 4 < 2
    pick = lambda m: [x for x, ok in zip(w, m) if ok]
    net.train(pick(half), y[half])
    net.calibrate(pick(~half), y[~half])
    s = net.scores(pick(~half))
    assert (s[y[~half] == 1] >= net.threshold).mean() >= sec.RECALL
    assert (s[y[~half] == 0] >= net.threshold).mean() < 0.1


def test_nothing_to_learn_from(spark):
    for rows in ([], [(1, None)], [(1, "token=abcdef")], [(1, "mail.123456789.example")]):
        got = sec.secret_scan(docs_frame(spark, rows)).collect()
        assert len(got) == len(rows) and all(not r.added for r in got)


def planted_corpus(n=400):
    """Base secrets, harmless candidates (mail, address, digits) and a few secrets that no pattern matches."""
    r = random.Random(3)
    run = lambda k, c: "".join(r.choice(c) for _ in range(k))
    hexa, b62 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    rows, planted = [], {}
    for k in range(n):
        pad = " ".join(f"word{r.randrange(9)}x" for _ in range(10))
        base = f"password={run(18, hexa)}" if k % 2 else f'token = "{run(24, b62)}"'
        rows.append((k, f"{pad} {base} {pad} mail{k}.{r.randrange(99)}@mail{k % 9}.example.com {run(16, '0123456789')} "
                        f"{r.randrange(100, 256)}.{r.randrange(100, 256)}.{r.randrange(100, 256)}.{r.randrange(100, 256)} {pad}"))
    for k in range(n, n + 20):
        value = run(20, hexa) if k % 2 else run(24, b62)
        rows.append((k, f"{pad} use {value} {pad}"))
        planted[k] = value
    return rows, planted


def test_planted_secrets_without_a_pattern_are_added(spark):
    rows, planted = planted_corpus()
    text = dict(rows)
    got = {r.doc_id: r for r in sec.secret_scan(docs_frame(spark, rows)).collect()}
    found = [k for k, value in planted.items() if any(value in text[k][s["start"]:s["end"]] for s in got[k].added)]
    assert len(found) >= 16
    assert sum(len(got[k].added) for k in text if k not in planted) < 60  # of 1,200 harmless candidates
    assert all(s["score"] < 1.0 for r in got.values() for s in r.base)  # base spans are scored, too


def test_windows_cover_every_run():
    r = random.Random(4)
    for _ in range(300):
        run = "".join(r.choice("ab=/._9") for _ in range(r.randint(12, 400)))
        starts = sec.window_starts("x " + run + " y", 2, 2 + len(run))
        assert starts[0] == 2 and all(any(s <= k < s + sec.BODY for s in starts) for k in range(2, 2 + len(run)))


def test_secrets_late_in_a_run_or_without_digits(spark):
    rows, _ = planted_corpus()
    r = random.Random(6)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    late, plain = {}, {}
    for k in range(1000, 1020):
        value = "".join(r.choice(letters + ("0123456789" if k < 1010 else "")) for _ in range(24))
        head = "/srv/www/pages/archive/summer/pictures/harbour/index.page=" if k < 1010 else ""
        rows.append((k, f"some words {head}{value} and more"))
        (late if k < 1010 else plain)[k] = head + value
    got = {x.doc_id: x for x in sec.secret_scan(docs_frame(spark, rows)).collect()}
    text = dict(rows)
    for part in (late, plain):
        assert sum(any(text[k][s["start"]:s["end"]] == v for s in got[k].added) for k, v in part.items()) >= 7


def test_made_findings_are_candidates():
    r = random.Random(8)
    for _ in range(500):
        for run in (sec.made_value(r), sec.made_plain(r, ["alpha", "beta", "river"])):
            assert sec.CANDIDATE.fullmatch(run)


def test_kinds_that_no_pattern_and_no_training_row_has(spark):
    """Six forms of keys among base secrets of one alphabet, and harmless runs of forms that the training does not make."""
    rows, _ = planted_corpus()
    r = random.Random(9)
    run = lambda n, c: "".join(r.choice(c) for _ in range(n))
    hexa, ten = "0123456789abcdef", "0123456789"
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + ten
    nouns = ["harbour", "window", "garden", "silver", "morning", "letter", "branch", "engine"]
    keys = {"ghp": lambda: "ghp_" + run(36, b62), "web": lambda: f"eyJ{run(17, b62)}.eyJ{run(40, b62 + '-_')}.{run(43, b62 + '-_')}",
            "chat": lambda: f"xoxb-{run(12, ten)}-{run(12, ten)}-{run(24, b62)}", "base64": lambda: run(43, b62 + "+/") + "=",
            "uuid": lambda: "-".join(run(n, hexa) for n in (8, 4, 4, 4, 12)), "hex": lambda: run(20, hexa)}
    plain = [lambda: "/usr/" + "/".join(r.sample(nouns, 3)) + ".html", lambda: "-".join(r.sample(nouns, 4)), lambda: f"{run(4, ten)}/{run(2, ten)}/{run(2, ten)}-{run(4, ten)}",
             lambda: "_".join(r.sample(nouns, 3)) + "_v2", lambda: "+" + run(13, ten), lambda: "www." + ".".join(r.sample(nouns, 2)) + ".org"]
    of, at = {}, 2000
    for name, make in [*keys.items(), *[("plain", p) for p in plain for _ in range(4)]]:
        for _ in range(30 if name != "plain" else 25):
            value = make()
            rows.append((at, f"some words here {value} and more of them"))
            of[at] = name, value
            at += 1
    text = dict(rows)
    got = {x.doc_id: x for x in sec.secret_scan(docs_frame(spark, rows)).collect()}
    hit = {k: any(v in text[k][s["start"]:s["end"]] or text[k][s["start"]:s["end"]] in v for s in [*got[k].added, *got[k].base]) for k, (_, v) in of.items()}
    for name in keys:
        assert sum(hit[k] for k, (n, _) in of.items() if n == name) >= 24, name
    harmless = [k for k, (n, _) in of.items() if n == "plain"]
    assert len(harmless) == 600 and sum(bool(got[k].added) for k in harmless) < 12


def test_every_finding_teaches_whatever_the_number_of_shards(spark, monkeypatch):
    """Findings beyond any one shard's: none is left out of the deal, each shard has both labels, and planted secrets are found."""
    rows, planted = planted_corpus()
    text = dict(rows)
    monkeypatch.setattr(sec, "SHARD_FINDINGS", 500)
    found = sec.findings(docs_frame(spark, rows))
    every = sum(len(r.spans) for r in found.collect())
    deal, shards = sec.dealt(found)
    got = deal.collect()
    assert shards >= 3 and sum(r.copy == 0 for r in got) == every == len({r.order for r in got})
    assert {(r.shard, r.label) for r in got} == {(k, label) for k in range(shards) for label in (0, 1)}
    added = {r.doc_id: r.added for r in sec.secret_scan(docs_frame(spark, rows)).collect()}
    assert sum(any(v in text[k][s["start"]:s["end"]] for s in added[k]) for k, v in planted.items()) >= 16
    assert sum(len(added[k]) for k in text if k not in planted) < 60
