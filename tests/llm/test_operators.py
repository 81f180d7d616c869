"""The corpus operators against brute force and edge cases."""

import collections
import hashlib
import random
import re
import time
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import (components, decontaminate, htmltext, langid, mixture, quality, rules, simhash, substring,
                           textops, toxicity, warc)
from riskweave.llm.common import importable
from riskweave.session import shared_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", "a", 3),
        (4, "one", "en", "a", 3), (None, "no id here", "en", None, 10), (6, "word " * 40000, "en", "a", 200000),
        (7, "Été über ñ 日本 \U0001F600", "fr", "b", 20)]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(autouse=True)
def _importable(spark):
    importable(spark)


def frame(spark, rows, clash=()):
    out = spark.createDataFrame(rows, DOCS)
    for c in clash:
        out = out.withColumn(c, F.lit("own"))
    return out


def prose(rng, n, stock):
    return " ".join(rng.choice(stock) for _ in range(n))


STOCK = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "")]


# --- words ------------------------------------------------------------------------

def test_words_and_hashes_match_python():
    texts = ["a bb  a", None, "", "\x0b", "É é\tÉ", "bb", "x" * 70000 + " a"]
    got = []
    for _, _, data, off in textops.chunks(pa.array(texts), limit=8):
        w = textops.words(data, off)
        h = textops.word_hashes(w)
        for r in range(w.rows):
            got.append(h[w.first[r]:w.first[r + 1]].tolist())
    names = [WORD.findall(t or "") for t in texts]
    assert [len(g) for g in got] == [len(n) for n in names]
    seen = {}
    for g, n in zip(got, names):
        for h, word in zip(g, n):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 180), rng.randrange(100, 180)) for _ in range(50)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for u, v in edges:
        parent[find(u)] = find(v)
    got = {r["node"]: r["label"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert set(got) == nodes
    groups = collections.defaultdict(set)
    for n in nodes:
        groups[find(n)].add(got[n])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- 3 SimHash -----------------------------------------------------------------------

def brute_fingerprint(text, n=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_covering_masks_clear_every_pair_of_bits():
    masks = simhash.covering_masks(2)
    for i in range(64):
        for j in range(64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


@pytest.mark.parametrize("dense", [4096, 1])
def test_simhash_links_equal_all_pairs(spark, dense):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    values = {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)} | {rng.getrandbits(64) for _ in range(40)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    nodes = spark.createDataFrame([(v,) for v in values], "fp long")
    got = components.connected_components(simhash.fingerprint_links(nodes, 2, dense)).collect()
    label = {r["node"]: r["label"] for r in got}
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in values:
        for b in values:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2:
                parent[find(a)] = find(b)
    for a in values:
        for b in values:
            assert (find(a) == find(b)) == (label.get(a, a) == label.get(b, b))


def test_simhash_edges(spark):
    got = simhash.near_duplicates(frame(spark, EDGE + [(9, "", None, None, 0)], clash=("fp", "fingerprint", "component_id", "label"))).collect()
    assert len(got) == len(EDGE) + 1
    by = {r["doc_id"]: r for r in got}
    for i, text, *_ in EDGE:
        assert by[i]["fingerprint"] == f"{brute_fingerprint(text):016x}"
    assert {by[i]["component_id"] for i in (1, 2, 3, 9)} == {1} and by[None]["component_id"] is None
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


# --- 4 rules -------------------------------------------------------------------------

def brute_statistics(t):
    t = t or ""
    w = WORD.findall(t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rules_base_statistics(spark):
    rng = random.Random(1)
    rows = [(10 + i, "\n".join(prose(rng, rng.randrange(0, 9), STOCK[:6] + ["a|b", "#", "\t"]) for _ in range(rng.randrange(1, 30))),
             "en", "a", 0) for i in range(30)] + EDGE
    got = rules.quality_rules(frame(spark, rows, clash=("n_words", "kept", "w", "s")), spark.createDataFrame([], LABELS)).collect()
    want = collections.Counter((i, *brute_statistics(t)) for i, t, *_ in rows)
    assert collections.Counter((r["doc_id"], *[r[c] for c in rules.BASE]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])  # nothing learned without labels
    assert rules.quality_rules(frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_rules_learn_thresholds(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 0
        words = [w + ("###" if bad and rng.random() < 0.5 else "") for w in (rng.choice(STOCK) for _ in range(120))]
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 0 if bad else 1, 0))
    got = rules.quality_rules(frame(spark, rows), spark.createDataFrame(labels + labels[:3], LABELS)).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == {i for i in range(240) if i % 4 == 0}


# --- 2 mixture ------------------------------------------------------------------------

def test_mixture_meets_marginals(spark):
    rows = [(i, prose(random.Random(i), 5 + i % 7, STOCK), ("en", "fr", None)[i % 3], "abbb"[i % 4], 0) for i in range(200)]
    cells = mixture.described(frame(spark, rows), "doc_id", "text", "source", "lang").groupBy(*mixture.DIMENSIONS).agg(
        F.sum("n_tokens").alias("tokens"))
    targets = {"source": {"a": 1.0, "b": 1.0}, "lang": {"en": 1.0, "fr": 0.6, mixture.NO_VALUE: 0.4}, "topic": {"prose": 2.0}}
    raked, error = mixture.rake(cells, targets=targets)
    got = raked.collect()
    assert error <= mixture.TOLERANCE
    for d, want in targets.items():
        for value, weight in want.items():
            assert sum(r["weight"] for r in got if r[d] == value) == pytest.approx(weight / 2, rel=1e-9)


def _mixed(spark, rows, **options):
    cells = mixture.described(frame(spark, rows), "doc_id", "text", "source", "lang")
    return mixture.cell_probabilities(cells, **options)


@pytest.mark.parametrize("budget", [0.02, 0.5, 0.97, 1.0])
def test_mixture_meets_its_token_budget(spark, budget):
    rows = [(i, prose(random.Random(i), 5 + i % 7, STOCK) + (" | x" if i % 5 == 0 else ""), ("en", "fr", None)[i * i % 3 % 2],
             "abbbcccc"[i % 8], 0) for i in range(300)]
    got = _mixed(spark, rows, budget=budget).collect()
    total = sum(r["tokens"] for r in got)
    assert sum(r["tokens"] * r["prob"] for r in got) == pytest.approx(budget * total, rel=1e-9)
    below = [r["prob"] * r["tokens"] / r["weight"] for r in got if r["prob"] < 1]
    assert not below or max(below) == pytest.approx(min(below))  # one factor for all cells that are not taken whole
    assert all(r["prob"] == 1 for r in got) == (budget == 1.0)


def test_mixture_yield_does_not_hang_on_a_rare_cell(spark):
    rows = [(i, prose(random.Random(i), 40, STOCK), ("en", "fr", "es")[i * i % 3], "abcd"[i % 4], 0) for i in range(600)]
    rare = rows + [(9999, "password = one two three", "zz", "rare", 0)]
    plain, more = ([r.asDict() for r in _mixed(spark, x).collect()] for x in (rows, rare))
    sizes = [sum(r["tokens"] * r["prob"] for r in x) for x in (plain, more)]
    assert abs(sizes[1] / sizes[0] - 1) < 0.01
    # each cell's documents are as likely as before, but for what the rare cell takes
    before = {(r["source"], r["lang"], r["topic"]): r["prob"] for r in plain}
    assert all(abs(r["prob"] / before[r["source"], r["lang"], r["topic"]] - 1) < 0.25 for r in more if r["source"] != "rare")


def test_mixture_report_and_targets_that_cannot_be_met(spark):
    rows = [(i, "one two three", "en" if i % 2 else "fr", "a" if i % 2 else "b", 0) for i in range(40)]
    probs = _mixed(spark, rows, budget=0.25)
    got = {(r["dimension"], r["value"]): r for r in mixture.report(probs).collect()}
    assert got["source", "a"]["expected"] == pytest.approx(got["source", "a"]["target"]) == pytest.approx(0.5)
    assert got["topic", "prose"]["expected_tokens"] == pytest.approx(0.25 * 120)
    cells = mixture.described(frame(spark, rows), "doc_id", "text", "source", "lang").groupBy(*mixture.DIMENSIONS).agg(
        F.sum("n_tokens").alias("tokens"))
    # source a is always English: both cannot have these shares
    _, error = mixture.rake(cells, targets={"source": {"a": 9.0, "b": 1.0}, "lang": {"en": 1.0, "fr": 9.0}}, max_sweeps=4)
    assert error > 0.5


def test_mixture_edges(spark):
    docs = frame(spark, EDGE, clash=("topic", "prob", "sampled", "weight"))
    got = mixture.mix(docs).collect()
    assert len(got) == len(EDGE)
    assert all(r["n_tokens"] == len(WORD.findall(t or "")) for r in got for i, t, *_ in EDGE if i == r["doc_id"])
    assert all(0 <= r["prob"] <= 1 for r in got)
    kept = mixture.sample(docs)
    assert kept.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter(r["doc_id"] for r in got if r["sampled"])
    assert mixture.mix(frame(spark, [])).count() == 0


# --- 1, 6 classifiers -------------------------------------------------------------------

def test_toxicity_gradients_and_fast_path():
    p = {k: v.astype(np.float64) for k, v in toxicity.fresh(0).items()}
    texts, y = ["a bb idiot ccc dd", "x yy zz", "idiot foo"], np.array([1.0, 0, 1])
    raw = [t.encode() for t in texts]
    w = textops.words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in raw])]))
    v = toxicity.vocabulary(w)
    first, length, _ = toxicity.windows(w)
    at, live = toxicity._steps(first, length, v.index)

    def loss():
        s = 1 / (1 + np.exp(-toxicity.forward(p, toxicity.embed(p, v), at, live)))
        return -np.log(np.where(y == 1, s, 1 - s)).mean()
    keep, x = {}, toxicity.embed(p, v)
    z = toxicity.forward(p, x, at, live, keep)
    g = toxicity.backward(p, x, v, at, live, keep, (toxicity._sigmoid(z) - y) / 3)
    for k in p:
        flat, i = p[k].reshape(-1), int(np.abs(g[k].reshape(-1)).argmax())
        old = flat[i]
        flat[i] = old + 1e-2
        up = loss()
        flat[i] = old - 1e-2
        down = loss()
        flat[i] = old
        assert g[k].reshape(-1)[i] == pytest.approx((up - down) / 2e-2, rel=1e-2, abs=1e-6)
    q = toxicity.fresh(0)
    assert np.allclose(toxicity.forward(q, toxicity.embed(q, v), at, live), toxicity.window_logits(q, v, first, length), atol=1e-5)


def test_toxicity_windows_cover_whole_texts():
    for n in (0, 1, 63, 64, 65, 112, 113, 500):
        data = np.frombuffer(b"w " * n, np.uint8)
        first, length, _ = toxicity.windows(textops.words(data, np.array([0, len(data)])))
        assert set().union(*[range(a, a + b) for a, b in zip(first, length)]) == set(range(n))


def test_toxicity_windows_hold_short_spans_whole():
    for n in (64, 65, 96, 113, 500):
        data = np.frombuffer(b"w " * n, np.uint8)
        first, length, _ = toxicity.windows(textops.words(data, np.array([0, len(data)])))
        for size in (17, 33):
            assert all(any(a <= s and s + size <= a + b for a, b in zip(first, length)) for s in range(n - size + 1))


@pytest.mark.parametrize("kind", ["toxic", "quality"])
def test_classifiers_learn_and_handle_edges(spark, kind):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(100, 400):
        on = i % 3 == 0
        words = [rng.choice(STOCK) for _ in range(60)]
        if on:
            words = words[:50] + ["vilebad", "vilely", "vileness"] if kind == "toxic" else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, int(not on), int(on)))
    docs = frame(spark, rows + EDGE, clash=("score", "predicted", "held_out", "label", "id"))
    module = toxicity if kind == "toxic" else quality
    marks = spark.createDataFrame(labels, LABELS)
    model = module.train(docs, marks)
    got = module.score(docs, model).collect()
    assert len(got) == len(rows) + len(EDGE) and all(0 <= r["score"] <= 1 for r in got)
    truth = {i: (t if kind == "toxic" else q) for i, q, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 30 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    none = module.train(docs, spark.createDataFrame([], LABELS))
    assert len({r["predicted"] for r in module.score(docs, none).collect()}) == 1
    assert module.score(frame(spark, []), model).count() == 0


def test_quality_learns_from_all_rows_and_pairs(spark):
    rng = random.Random(47)
    # labels that the texts hardly show, so that the threshold lies among both classes
    words = [s.upper() if n % 9 == 0 else s + "," * (n % 4 == 0) for n, s in enumerate(STOCK)]
    rows = [(i, prose(rng, rng.randint(8, 60), words), "en", "a", 0) for i in range(10000)]
    labels = [(i, int(len(r[1]) > 150 if rng.random() < 0.3 else rng.random() < 0.55), 0) for i, r in enumerate(rows)]
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    model = quality.train(docs, marks)
    got = [r for r in quality.score(docs, model).collect() if not r["held_out"]]
    bad = sum(not labels[r["doc_id"]][1] for r in got)
    assert bad > 3000 and len(got) - bad > 3000  # more than one bounded sample would hold
    assert abs(sum(not r["predicted"] for r in got) - bad) <= 2
    few = [r for r in got if r["doc_id"] < 300]
    x = quality.text_statistics(pa.array([rows[r["doc_id"]][1] for r in few]))
    good = np.array([labels[r["doc_id"]][1] == 1 for r in few])
    stats = spark.createDataFrame([(int(g), v.tolist()) for g, v in zip(good, x)], "label int, x array<double>")
    basis, rank = model.basis(x), model.rank(x)
    lost = 1 / (1 + np.exp(rank[good][:, None] - rank[~good][None]))
    brute = -(lost.mean(axis=1) @ basis[good] / good.sum() - lost.mean(axis=0) @ basis[~good] / (~good).sum())
    assert np.allclose(quality.gradient(stats, model), brute, atol=5e-3)


def test_toxicity_learns_from_long_texts_alone(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(100, 160):  # every labelled text has over 30,000 characters
        words = [rng.choice(STOCK) for _ in range(9000)]
        if i % 2:
            at = rng.randrange(8900)
            words[at:at + 12] = ["vilebad", "vilely", "vileness", "vilebad"] * 3
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 1, i % 2))
    assert min(len(r[1]) for r in rows) > 30000
    docs = frame(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    got = toxicity.score(docs, model).collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 5 and all(r["predicted"] == r["doc_id"] % 2 for r in held)


def test_toxicity_sample_is_bounded_by_characters_and_takes_every_length(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, seed: seen.append((texts, toxic)) or toxicity.fresh(0))
    rows = [(i, f"w{i} " * (5000 if i % 3 == 0 else 20), "en", "a", 0) for i in range(400)] + [(7, "again", "en", "a", 0)] * 3
    marks = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], LABELS)
    toxicity.train(frame(spark, rows), marks, chars=100_000, piece=4000)
    texts, toxic = seen[0]
    for side in (True, False):
        sizes = [len(t) for t, y in zip(texts, toxic) if y == side]
        assert 100_000 <= sum(sizes) < 104_000 and max(sizes) == 4000 and min(sizes) < 200
    seen.clear()
    toxicity.train(frame(spark, rows), marks)
    texts, toxic = seen[0]
    assert len(texts) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(400))


# --- 8 language ------------------------------------------------------------------------

def test_language_by_dictionary(spark):
    rng = random.Random(6)
    stocks = {"en": ["the", "thing", "ever", "nothing", "with"], "fr": ["eau", "que", "mieux", "entre", "oiseau"]}
    rows = [(i, prose(rng, 40, stocks[k]), k, "a", 0) for i in range(100, 220) for k in [("en", "fr")[i % 2]]]
    docs = frame(spark, rows + EDGE + [(500, "1234 !!", "en", "a", 7)], clash=("lang_pred", "score", "rank"))
    got = langid.language_id(docs).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + len(EDGE) + 1
    assert all(by[i]["lang_pred"] == k for i, _, k, *_ in rows)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 500))
    assert langid.language_id(frame(spark, [])).count() == 0


def test_language_dictionaries_fill_up_from_whole_texts(spark):
    rng = random.Random(3)
    early, late = STOCK[::2], STOCK[1::2]
    # each text's first 60,000 characters have other words than the rest
    rows = [(i, prose(rng, 15000, early) + " " + prose(rng, 40000, late), "long", "s", 0) for i in range(6)]
    rows += [(100 + i, prose(rng, 12, STOCK), "short", "s", 0) for i in range(900)]
    size = 1 << 15
    got = langid.train(frame(spark, rows), size=size)
    assert size - 4 <= len(got["long"]) <= size and len(got["short"]) <= size
    words = set(got["long"].decode().split())
    assert words & set(late)  # beginnings alone have none of them
    # the few short texts are used whole
    assert abs(len(got["short"]) - 400 * len(rows[50][1])) < 400 * 12


def test_shares_of_a_dictionary():
    rng = random.Random(1)
    for _ in range(200):
        texts = [b"x" * rng.randrange(0, 40) for _ in range(rng.randrange(1, 12))]
        size = rng.randrange(12, 400)
        got = langid.shared(texts, size)
        assert len(b" ".join(got)) <= size
        cut = [len(g) for g, t in zip(got, texts) if len(g) < len(t)]
        assert all(t.startswith(g) for g, t in zip(got, texts))
        assert not cut or (max(cut) - min(cut) <= 1 and max(map(len, got)) <= max(cut) and size - len(b" ".join(got)) < len(texts))


# --- 5 HTML ------------------------------------------------------------------------------

def test_html_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <!-- <p>no</p> --><article><h1>Title &amp; more</h1><p>One  two<br>three <b>bold</b>&nbsp;end.<p>Short.</p><div class="ad">Buy</div>
    <p>Last &lt;one&gt; here.</p></article><section class="comments"><p>Reader says many words here, really many.</p></section>
    <form><label>Mail</label></form><aside><p>Side</p></aside><footer>&copy; foot</footer></body></html>"""
    assert htmltext.main_text(page) == "Title & more\nOne two three bold end.\nShort.\nLast <one> here."
    assert [htmltext.main_text(x) for x in (None, "", "<", "<script>x", "<!-- open")] == [""] * 5
    assert htmltext.main_text(page[:page.index("Last") + 8]).endswith("Last <")


WRAPPERS = ("site has-sidebar", "post tag-legal", "page-wrapper nav-open", "story more", "article-body share-on",
            "comments-closed hentry")


@pytest.mark.parametrize("around", WRAPPERS)
@pytest.mark.parametrize("tag", ["article", "div"])
def test_html_names_of_wrappers_do_not_empty_the_page(around, tag):
    parts = ["Title of it", "First paragraph with several words of text.", "Second paragraph with more words."]
    body = (f"<nav><a href=x>home</a> <a href=y>news</a></nav><{tag}><h1>{parts[0]}</h1><p>{parts[1]}</p><p>{parts[2]}</p></{tag}>"
            "<aside>Side words here.</aside><div class='comments'><p>I like this a lot, said a reader.</p></div><footer>me</footer>")
    want = "\n".join(parts)
    assert htmltext.main_text(f"<html><body><div class='{around}'>{body}</div></body></html>") == want
    assert htmltext.main_text(f"<body class='{around}'><form id=aspnetForm>{body}</form></body>") == want
    assert htmltext.main_text(f"<body><div class='{around}'><div><section class='{around}'>{body}</section></div></div></body>") == want


def test_html_planted_pages_give_their_article():
    rng = random.Random(5)
    waste = ["<nav class='menu'><ul><li><a href=a>{0}</a><li><a href=b>{0}</a></ul></nav>", "<aside><p>{0}</p></aside>",
             "<div class=\"cookie-notice\"><p>{0}</p></div>", "<form><label>{0}</label><input name=q></form>",
             "<div class='ad'>{0}</div>", "<section id=comments><div class='comment'><p>{0}</p></div></section>",
             "<div class='related-posts'><h3>{0}</h3><a href=c>{0}</a></div>", "<script>var a = '<p>{0}</p>';</script>",
             "<!-- <p>{0}</p> -->", "<div role=navigation>{0}</div>", "<p hidden>{0}</p>", "<div style='display: none'>{0}</div>"]
    for n in range(120):
        def words(lo, hi):
            return prose(rng, rng.randrange(lo, hi), STOCK)
        parts = [words(8, 60) for _ in range(rng.randrange(2, 8))]
        inner = "".join(f"<p title='it's'>{x}" + rng.choice(["</p>", ""]) for x in parts)
        junk = [rng.choice(waste).format(words(3, 25)) for _ in range(6)]
        page = (f"<!DOCTYPE html><head><title>{words(2, 5)}</title></head><body class='{rng.choice(WRAPPERS)}'>{junk[0]}"
                f"<div class='{rng.choice(WRAPPERS)}'>{junk[1]}{junk[2]}<article>{inner}{junk[3]}</article>{junk[4]}</div>{junk[5]}"
                f"<footer>&copy; {words(3, 9)}</footer></body>")
        assert htmltext.main_text(page) == "\n".join(parts), page


@pytest.mark.parametrize("name, evidence", [
    ("ad", htmltext.STRONG), ("sidebar-left", htmltext.STRONG), ("legal", htmltext.STRONG), ("box legal", htmltext.WEAK),
    ("post legal", 0.0), ("post-comments widget", htmltext.STRONG), ("post comments", htmltext.WEAK), ("post tag-legal", 0.0),
    ("has-sidebar", 0.0), ("", 0.0), ("adrift", 0.0)])
def test_html_evidence_of_names(name, evidence):
    assert htmltext.name_evidence(name)[0] == evidence


def test_html_odd_quotes_leak_no_markup():
    assert htmltext.main_text("<article><p title='it's'>Words of the text go on.</p><p class=\"a\"b\">More of it here.</p></article>") == (
        "Words of the text go on.\nMore of it here.")
    assert htmltext.main_text("<article><p data-x=a\"b alt=''c'>Words of the text go on.</p></article>") == "Words of the text go on."


@pytest.mark.parametrize("piece", ["<div>some more words of text ", "<div>word </span></li><a href=x>b", "<ul><li><p>word</i>"])
def test_html_time_follows_the_page_at_any_depth(piece):
    start = time.process_time()
    htmltext.main_text(piece * 8000)
    assert time.process_time() - start < 1.5


def test_minimum_cut_equals_exhaustive_search():
    rng = random.Random(7)
    for _ in range(60):
        n = rng.randrange(1, 8)
        content, boiler = [[rng.random() * 3 for _ in range(n)] for _ in range(2)]
        edges = [(i, j, rng.random()) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(keep):
            return (sum(content[i] if keep[i] else boiler[i] for i in range(n))
                    + sum(w for i, j, w in edges if keep[i] != keep[j]))
        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(htmltext.minimum_cut(content, boiler, edges)) == pytest.approx(best)


def test_html_edges(spark):
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (None, "u", "<article><p>many good words of text here</p></article>"),
            (3, "u", "<article>" + "<p>some words of a long page</p>" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    got = {r["page_id"]: r for r in htmltext.extract(pages).collect()}
    assert got[1]["text"] == "" and got[1]["n_chars"] == 0 and got[None]["text"] == "many good words of text here"
    assert got[3]["text"].count("\n") == 4999


# --- 7 WARC ------------------------------------------------------------------------------

def test_warc_round_trip(spark):
    big, other = "é" * 600, "x" * 5000
    rows = [(1, "http://a/\r\nX: y", big), (5, None, big), (3, "http://c", big), (4, "u", "small"), (6, "u", "small"),
            (7, "u", None), (None, "u", big), (8, "u", other + "\r\n\r\nWARC/1.1\r\n"), (8, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("own"))
    path = shared_path(spark, "warc-" + uuid.uuid4().hex)
    warc.write(warc.page_records(pages), path)
    got = warc.page_index(spark, path).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows)
    assert by[5]["record_type"] == "response" and [by[i]["refers_to"] for i in (1, 3, None)] == [5, 5, 5]
    assert {by[i]["record_type"] for i in (4, 6, 7, 8)} == {"response"} and by[7]["payload_bytes"] == 0
    assert by[1]["payload_digest"] == hashlib.sha1(big.encode()).hexdigest() and by[1]["payload_bytes"] == 1200
    full = warc.read(spark, path)
    assert {bytes(r["payload"]).decode() for r in full.where("record_type = 'response'").collect()} == {
        big, "small", "", other + "\r\n\r\nWARC/1.1\r\n"}
    plan = full.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Filter \(", plan)
    empty = shared_path(spark, "warc-" + uuid.uuid4().hex)
    warc.write(warc.page_records(pages.limit(0)), empty)
    assert warc.page_index(spark, empty).count() == 0


def test_warc_skips_unwanted_payloads(tmp_path):
    raw = b"".join(warc.record("response", f"<urn:page:{i}>", "u", "d", b"z" * 300_000, None, 300_000) for i in range(20))
    file = tmp_path / "a.warc"
    file.write_bytes(raw)
    fetched = []
    original = warc._Window.__init__

    def spy(self, *a):
        original(self, *a)
        fetched.append(self)
    warc._Window.__init__ = spy
    try:
        with open(file, "rb") as f:
            rows = list(warc.scan_records(f, 0, len(raw), lambda r: r[1] == "<urn:page:7>", False))
    finally:
        warc._Window.__init__ = original
    assert len(rows) == 1 and rows[0][-1] is None and fetched[0].fetched < len(raw) / 3


# --- 9 passages --------------------------------------------------------------------------

def test_chains_score_like_quadratic_search():
    rng = random.Random(8)
    for _ in range(40):
        n = rng.randrange(2, 25)
        a = np.sort(np.array([rng.randrange(60) for _ in range(n)]))
        b = np.array([rng.randrange(60) for _ in range(n)])
        got = substring.chains(a, b, max_gap=1000)
        value = [5.0] * n
        for i in range(n):
            for j in range(i):
                if a[j] < a[i] and b[j] < b[i]:
                    value[i] = max(value[i], value[j] + 5 - 0.05 * (a[i] - a[j] + b[i] - b[j]))
        total = lambda c: 5 * len(c) - 0.05 * (a[c[-1]] - a[c[0]] + b[c[-1]] - b[c[0]])
        best = max(value)
        assert max([5.0, *map(total, got)]) == pytest.approx(best)
        flat = [i for c in got for i in c]
        assert len(flat) == len(set(flat))


def test_chains_after_a_wide_gap():
    near = lambda lo, n: np.arange(lo, lo + n, 10)
    for first, second in ((100, 60), (400, 60), (60, 400)):
        for skip, shift in ((150, 130), (130, 400), (600, 200)):  # words between the passages in either document
            a = np.concatenate([near(0, first), near(first + skip, second)])
            b = np.concatenate([near(0, first), near(first + shift, second)])
            got = substring.chains(a, b)
            assert sorted(len(c) for c in got) == sorted([first // 10, second // 10])
    a = np.concatenate([near(0, 200), near(500, 200)])  # a long insertion into one copy
    assert [len(c) for c in substring.chains(a, near(0, 400))] == [20, 20]
    rng = np.random.default_rng(7)
    for n in (5, 30, 60):
        a, b = np.sort(rng.integers(0, 1500, n)), rng.integers(0, 600, n)
        value = [5.0] * n
        for i in range(n):
            for j in range(i):
                if 0 < a[i] - a[j] <= 105 and 0 < b[i] - b[j] <= 105:
                    value[i] = max(value[i], value[j] + 5 - 0.05 * (a[i] - a[j] + b[i] - b[j]))
        total = lambda c: 5 * len(c) - 0.05 * (a[c[-1]] - a[c[0]] + b[c[-1]] - b[c[0]])
        assert max([5.0, *map(total, substring.chains(a, b))]) == pytest.approx(max(value))


def test_passages_found_exactly_once_each_later_copy(spark):
    rng = random.Random(9)
    passage, fuzzy = [rng.choice(STOCK) + str(i) for i in range(80)], [rng.choice(STOCK) + "x" + str(i) for i in range(120)]
    rows = []
    for i in range(40):
        w = [f"{rng.choice(STOCK)}{rng.randrange(10**6)}" for _ in range(100)]
        if i % 2:
            w[30:30] = passage
        if i in (4, 20):
            part = list(fuzzy)
            if i == 20:
                for k in (15, 40, 77):
                    part[k] = "changed"
                del part[60]
            w[50:50] = part
        rows.append((i, " ".join(w), "en", "a", 0))
    docs = frame(spark, rows + [(100 + (r[0] or 0), *r[1:]) if r[0] else r for r in EDGE], clash=("h", "ref", "passages", "a", "b"))
    got = substring.repeated_passages(docs).where("doc_id < 100").collect()
    found = {r["doc_id"]: r for r in got}
    assert set(found) == {i for i in range(3, 40, 2)} | {20} and all(found[i]["ref_doc_id"] == 1 for i in range(3, 40, 2))
    assert all((found[i]["start_word"], found[i]["n_words"]) == (30, 80) for i in range(3, 40, 2))
    assert found[20]["ref_doc_id"] == 4 and abs(found[20]["n_words"] - 119) <= 2 and found[20]["identity"] > 0.95
    cleaned = {r["doc_id"]: r for r in substring.remove_repeats(docs.where("doc_id < 100")).collect()}
    assert cleaned[1]["text"] == rows[1][1] and cleaned[3]["text"].split() == [w for w in rows[3][1].split() if w not in passage]
    assert cleaned[3]["n_chars"] == len(cleaned[3]["text"]) and len(cleaned) == 40
    assert substring.repeated_passages(frame(spark, [])).count() == 0


def edited_pairs(rng, size, share, count, first):
    """Documents in pairs that share a passage, the later copy with words replaced."""
    word = lambda: f"{rng.choice(STOCK)}{rng.randrange(10**8)}"
    rows = []
    for n in range(count):
        part = [word() for _ in range(size)]
        for copy in range(2):
            w = [word() for _ in range(120)]
            w[40:40] = part
            rows.append((first + 2 * n + copy, " ".join(w), "en", "a", 0))
            for at in rng.sample(range(1, size - 1), round(size * share)):
                part[at] = word()
    return rows


def test_edited_passages_are_found(spark):
    rng = random.Random(19)
    kinds = [(55, 0.1, 0.9), (55, 0.2, 0.7), (65, 0.2, 0.85), (80, 0.1, 0.95), (80, 0.2, 0.95)]
    rows = [r for n, (size, share, _) in enumerate(kinds) for r in edited_pairs(rng, size, share, 60, 1000 * n)]
    found = substring.repeated_passages(frame(spark, rows)).collect()
    assert all(r["identity"] >= 0.8 and r["ref_doc_id"] == r["doc_id"] - 1 and r["doc_id"] % 2 for r in found)
    for n, (size, share, least) in enumerate(kinds):
        own = [r for r in found if r["doc_id"] // 1000 == n]
        assert len({r["doc_id"] for r in own}) >= least * 60, (size, share, len(own))
        assert all(38 <= r["start_word"] and r["start_word"] + r["n_words"] <= 42 + size for r in own)


@pytest.mark.parametrize("lines,size", [(5, 12), (4, 15), (2, 25)])
def test_passages_of_frequent_lines_are_found(spark, lines, size):
    rng = random.Random(23)
    word = lambda: f"{rng.choice(STOCK)}{rng.randrange(10**8)}"
    rows, later = [], set()
    for n in range(40):
        part = [[word() for _ in range(size)] for _ in range(lines)]
        bodies = [[line] for line in part] + [part, part]  # each line comes first in a document of its own
        for m, body in enumerate(bodies):
            w = [word() for _ in range(80)]
            w[30:30] = [x for line in body for x in line]
            rows.append((100 * n + m, " ".join(w), "en", "a", 0))
        later.add(100 * n + lines + 1)
    got = {r["doc_id"]: r for r in substring.repeated_passages(frame(spark, rows)).collect()}
    assert later <= set(got)
    assert all(abs(got[i]["start_word"] - 30) <= 2 and abs(got[i]["n_words"] - lines * size) <= 4 for i in later)


def test_segments_agree_enough_as_a_whole():
    rng = np.random.default_rng(4)
    for n in (30, 80, 300):
        for share in (0.5, 0.7, 0.79, 0.85, 1.0):
            same = rng.random(n) < share
            got = substring.segments(same)
            assert all(e - s >= 20 and c == same[s:e].sum() and c >= 0.8 * (e - s) - 1e-5 for s, e, c in got)
            assert all(x[1] <= y[0] for x, y in zip(got, got[1:]))


def test_cover_keeps_the_words_and_the_longest():
    rng = random.Random(31)
    for _ in range(400):
        found = [(s, s + rng.randint(1, 30), rng.randint(0, 50), 1) for s in (rng.randint(0, 120) for _ in range(rng.randint(0, 12)))]
        got = substring.cover(found)
        words = lambda x: {w for s, e, _, _ in x for w in range(s, e)}
        assert words(got) == words(found) and set(got) <= set(found) and len(got) == len(set(got))
        assert not found or max(e - s for s, e, _, _ in got) == max(e - s for s, e, _, _ in found)


def test_alignment_gives_one_row_per_document(spark):
    rng = random.Random(37)
    word = lambda: f"{rng.choice(STOCK)}{rng.randrange(10**8)}"
    blocks, rows = [[word() for _ in range(30)] for _ in range(8)], []
    for n in range(40):  # every document shares other pieces with every other
        w = [word() for _ in range(20)]
        for part in rng.sample(blocks, 5):
            w += part + [word() for _ in range(20)]
        rows.append((n, " ".join(w), "en", "a", 0))
    wide = [(100 + n, " ".join(word() for _ in range(10)) + " " + " ".join(x for p in blocks[n % 3:n % 3 + 3] for x in p), "en", "a", 0) for n in range(20)]
    texts = frame(spark, rows + wide).select("doc_id", "text")
    found = substring.seeds(texts)
    chain = substring.chained(substring.first_links(substring.shared(found)))
    assert chain.count() > 100
    got = substring.aligned(chain, substring.signatures(texts)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(100, 120))  # of the others no repeat reaches 50 words
    assert all([(m["start_word"], m["n_words"]) for m in r["passages"]] == [(10, 90)] for r in got)


def test_promising_anchors_hold_every_segment():
    rng = np.random.default_rng(41)
    x = rng.integers(0, 256, 60 * 300).astype(np.uint8)
    y = np.where(rng.random(len(x)) < np.repeat(rng.uniform(0, 0.95, 60), 300), 7, x).astype(np.uint8)
    at = np.arange(60) * 300 + rng.integers(0, 296, 60)
    span = np.column_stack([np.arange(60) * 300, np.arange(60) * 300 + 300])
    got = substring.promising(x, y, at, at, span, span)
    for i, (lo, hi) in enumerate(span):
        s, e = max(lo, at[i] - 100), min(hi, at[i] + 105)
        assert got[i] or not substring.segments((x == y)[s:e])
    assert 0 < got.sum() < 60


@pytest.mark.parametrize("each,apart,least", [(1, 12, 7), (12, 24, 4)])
def test_passages_of_seeds_first_seen_elsewhere(spark, each, apart, least):
    rng = random.Random(43)
    word = lambda: f"{rng.choice(STOCK)}{rng.randrange(10**8)}"
    rows, later = [], set()
    for n in range(8):  # overlapping pieces of 18 words come first, in ``each`` documents
        part, base = [word() for _ in range(96)], 1000 * n
        for m in range(14 * each):
            at = 6 * (m // each)
            rows.append((base + m, " ".join([word() for _ in range(10)] + part[at:at + 18] + [word() for _ in range(10)]), "en", "a", 0))
        for copy in range(2):  # then the passage, then it again with words changed
            rows.append((base + 900 + copy, " ".join([word() for _ in range(30)] + part + [word() for _ in range(30)]), "en", "a", 0))
            part = [word() if i % apart == 7 else w for i, w in enumerate(part)]
        later.add(base + 901)
    got = {r["doc_id"]: r for r in substring.repeated_passages(frame(spark, rows)).collect()}
    found = [i for i in later if i in got and got[i]["ref_doc_id"] == i - 1 and got[i]["n_words"] >= 80]
    assert len(found) >= least


def test_shared_seeds_give_every_link_once(spark):
    rng = random.Random(47)
    rows = {(rng.randrange(30), rng.choice((1, 2, 3 + rng.randrange(60))), rng.randrange(40)) for _ in range(260)} | {(50, 77, p) for p in range(30)}
    by_seed: dict[int, list] = {}
    for d, h, p in sorted(rows):
        by_seed.setdefault(h, []).append((d, p))
    want = []
    for h, at in by_seed.items():
        if at[0][0] != at[-1][0]:
            want += [(d, h, p, *(at[0] if len(at) > substring.FEW else e), len(at) > substring.FEW) for n, (d, p) in enumerate(at)
                     for e in at[:1 if len(at) > substring.FEW else n] if len(at) > substring.FEW or e[0] < d]
    found = spark.createDataFrame([(d, h, p) for d, h, p in rows], "doc_id long, h long, p int")
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for n in ("1", "7", "1000"):
            spark.conf.set(size, n)
            assert sorted(map(tuple, substring.shared(found).collect())) == sorted(want)
    finally:
        spark.conf.set(size, before)
    assert {x[-1] for x in want} == {True, False}


def near_copies(rng, count):
    """Documents with the same 200 words, but for one of them in each, and some of their own."""
    word = lambda: f"{rng.choice(STOCK)}{rng.randrange(10**8)}"
    part, rows = [word() for _ in range(200)], []
    for n in range(count):
        own = list(part)
        own[rng.randrange(200)] = word()
        rows.append((n, " ".join([word() for _ in range(20)] + own + [word() for _ in range(20)]), "en", "a", 0))
    return rows


def test_runs_of_near_copies_make_links_alone(spark, monkeypatch):
    made = []
    plain = type(spark.range(1)).mapInArrow

    def noted(self, *args, **kwargs):
        made.append(plain(self, *args, **kwargs))
        return made[-1]

    rows, size = near_copies(random.Random(61), 160), {}
    for count in (80, 160):
        found = substring.shared(substring.seeds(frame(spark, rows[:count]).select("doc_id", "text"))).cache()
        long = [tuple(r) for r in substring.runs(found.where("frequent")).collect()]
        places: dict[int, list] = {}
        for d, h, p, ref, q in sorted(long):
            places.setdefault(h, []).append((d, p, ref, q))
        want = [tuple(r) for r in found.where("doc_id <> ref").select("doc_id", "ref", "p", "q").collect()]
        before = len(want)
        for at in places.values():
            for n, (d, p, ref, q) in enumerate(at):
                for e in at[:1] if len(at) > substring.FEW else at[:n]:
                    if e[0] < d and e[:2] != (ref, q):
                        want.append((d, e[0], p, e[1]))
        with monkeypatch.context() as m:
            m.setattr(type(found), "mapInArrow", noted)
            got = substring.links(found)
        assert sorted(map(tuple, got.collect())) == sorted(want)
        size[count] = made[-1].count()  # what the pass over the runs makes: no row but the links
        assert 0 < size[count] == len(want) - before < 0.2 * len(long)
        found.unpersist()
    assert size[160] < 3 * size[80]  # in proportion to the copies


def test_runs_of_a_repeated_line_are_one_row_a_document(spark, monkeypatch):
    made = []
    plain = type(spark.range(1)).mapInArrow

    def noted(self, *args, **kwargs):
        made.append(plain(self, *args, **kwargs))
        return made[-1]

    rng, rows, places = random.Random(67), {}, {}
    word = lambda: f"{rng.choice(STOCK)}{rng.randrange(10**8)}"
    line, other = ([word() for _ in range(12)] for _ in range(2))
    for times in (40, 80):  # of the line in each document; one line in two more of them
        docs = [(n, " ".join([word() for _ in range(20)] + line * (times + n) + other * (n % 7 == 3) + line * 3 + [word() for _ in range(20)]),
                 "en", "a", 0) for n in range(14)]
        found = substring.shared(substring.seeds(frame(spark, docs).select("doc_id", "text"))).cache()
        by_doc: dict[int, list] = {}
        for x in sorted(map(tuple, found.where("frequent").select("doc_id", "p", "h", "ref", "q").collect())):
            by_doc.setdefault(x[0], []).append(x[1:])
        at_run: dict[tuple, list] = {}
        for d, own in by_doc.items():
            for k in range(1, 12):
                for i in range(len(own) - 2**k + 1):
                    part = own[i:i + 2**k]
                    if all(b[0] - a[0] <= substring.MAX_GAP + substring.K for a, b in zip(part, part[1:])):
                        at_run.setdefault(tuple(x[1] for x in part), []).append((d, part[0][0], *part[0][2:]))
        want = [tuple(r) for r in found.where("doc_id <> ref").select("doc_id", "ref", "p", "q").collect()]
        for at in at_run.values():
            for n, (d, p, ref, q) in enumerate(at):
                want += [(d, e[0], p, e[1]) for e in (at[:1] if len(at) > substring.FEW else at[:n]) if e[0] < d and e[:2] != (ref, q)]
        with monkeypatch.context() as m:
            m.setattr(type(found), "mapInArrow", noted)
            got = substring.links(found)
        assert sorted(map(tuple, got.collect())) == sorted(want)
        assert sorted((d, p, ref, q) for at in at_run.values() for d, p, ref, q in at) == sorted(
            (r["doc_id"], r["p"], r["ref0"], r["q0"]) for r in substring.runs(found.where("frequent")).collect())
        rows[times], places[times] = made[-2].count(), sum(map(len, at_run.values()))  # the runs that are dealt out
        assert rows[times] == sum(len({x[0] for x in at}) for at in at_run.values()) < 0.2 * places[times]
        found.unpersist()
    assert places[80] > 1.9 * places[40] and rows[80] < 1.5 * rows[40]  # as its length doubles


def test_places_come_in_parts():
    rng = random.Random(71)
    rows = [(n // 3, n, 100 * n, [100 * n + k + 1 for k in range(rng.choice((0, 0, 1, 9, 40)))]) for n in range(60)]
    batch = pa.table({"doc_id": [r[0] for r in rows], "h": [r[1] for r in rows], "p": [r[2] for r in rows], "ref0": [7] * 60,
                      "more": pa.array([r[3] for r in rows], pa.list_(pa.int32()))}).to_batches()[0]
    for part in (batch, batch.slice(17, 20), batch.slice(60)):
        own = rows[17:37] if len(part) == 20 else rows[:len(part)]
        want = [[d, h, x, 7] for d, h, p, more in own for x in [p, *more]]
        for most in (1, 16, 1 << 16):
            assert np.concatenate(list(substring._places(part, most))).tolist() == want


def test_reaches_hold_every_segment():
    rng = np.random.default_rng(53)
    x = rng.integers(0, 256, 80 * 300).astype(np.uint8)
    part = np.repeat(rng.uniform(0.2, 1, 80 * 10), 30)  # agreement changes every 30 words
    y = np.where(rng.random(len(x)) < part, x, x ^ 1)
    at = np.arange(80) * 300 + rng.integers(0, 296, 80)
    span = np.column_stack([np.arange(80) * 300, np.arange(80) * 300 + 300])
    some = 0
    for i, (lo, hi) in zip(at, substring.reaches(x, y, at, at, span, span)):
        s, e = max(i // 300 * 300, i - 100), min(i // 300 * 300 + 300, i + 105)
        got = [(s + a, s + b, n) for a, b, n in substring.segments((x == y)[s:e])]
        assert all(i + lo <= a and b <= i + hi for a, b, _ in got)
        assert got == [(i + lo + a, i + lo + b, n) for a, b, n in substring.segments((x == y)[i + lo:i + hi])]
        some += bool(got)
    assert 0 < some


def test_covered_stretches():
    rng = random.Random(59)
    for _ in range(200):
        own, found = [], []
        for _ in range(12):
            s, r = rng.randrange(100), rng.randrange(5)
            e = s + rng.randint(1, 25)
            inside = [g for g in own if g[0] <= s and e <= g[1]]
            assert substring.settled(own, s, e, r) == any((e - s, -r) < g[2] for g in inside)
            substring.spread(own, s, e, r)
            found.append((s, e, r))
        assert all(x[1] < y[0] for x, y in zip(own, own[1:]))
        assert {w for s, e, _ in own for w in range(s, e)} == {w for s, e, _ in found for w in range(s, e)}
        assert all(g[2] == max((e - s, -r) for s, e, r in found if g[0] <= s and e <= g[1]) for g in own)


# --- 10 benchmark ---------------------------------------------------------------------------

def levenshtein_inside(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def test_edit_distance_against_table():
    rng = np.random.default_rng(1)
    for _ in range(100):
        item, text = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 14))
        edits, start, end = decontaminate.edit_distance(item, text)
        assert edits == levenshtein_inside(item.tolist(), text.tolist())
        assert decontaminate.edit_distance(item, text[start:end])[0] <= edits


def test_contamination_recall_and_precision(spark):
    rng = random.Random(10)
    items = [(i, prose(rng, rng.randrange(15, 60), STOCK)) for i in range(40)] + [(99, None), (98, ""), (97, "too short")]
    rows, planted = [], set()
    for d in range(160):
        w = [rng.choice(STOCK) for _ in range(200)]
        if d % 2:
            i, text = items[rng.randrange(40)]
            part = text.split()
            for _ in range(len(part) // 10 if d % 4 == 3 else 0):
                part[rng.randrange(len(part))] = "edited"
            at = rng.randrange(200)
            w[at:at] = part
            planted.add((d, i))
        rows.append((d, " ".join(w), "en", "a", 0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows, clash=("item_id", "m", "edits"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert len(planted & got) >= 0.95 * len(planted) and not {d for d, _ in got} - {d for d, _ in planted}
    blocks = decontaminate.contamination(docs, bench, block_words=200).collect()
    assert {(r["doc_id"], r["item_id"]) for r in blocks} >= {p for p in planted if p[0] % 4 == 1}
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {d for d in range(160)} - {d for d, _ in got}
    assert decontaminate.contamination(frame(spark, EDGE), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0


def test_short_items_match_word_for_word(spark):
    rows = [(1, "x one Two three four y one two three four", "en", "a", 0), (2, "one two three", "en", "a", 0),
            (3, "four", "en", "a", 0), (4, "solo", "en", "a", 0), (5, "one two", "en", "a", 0), (6, "three four", "en", "a", 0),
            (7, None, "en", "a", 0)]
    short = [(1, "One two three four"), (2, "solo"), (3, "one two three four"), (4, " "), (5, None), (6, "two three")]
    long_item = [(9, "these words are in no text at all")]
    for items in (short, short + long_item):
        bench = spark.createDataFrame(items, "item_id long, text string")
        got = {tuple(r) for r in decontaminate.contamination(frame(spark, rows), bench).collect()}
        assert got == {(1, 1, 1, 4, 0), (1, 3, 1, 4, 0), (1, 6, 2, 2, 0), (2, 6, 1, 2, 0), (4, 2, 0, 1, 0)}
        assert sorted(r["doc_id"] for r in decontaminate.clean(frame(spark, rows), bench).collect()) == [3, 5, 6, 7]
