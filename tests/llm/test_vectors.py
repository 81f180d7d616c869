"""Hard negatives, centroid clustering and fingerprints against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.llm import centroids, digest, gnat, vectors
from riskweave.llm.common import importable

EMB = "vec_id long, embedding array<float>, label int"


@pytest.fixture(autouse=True)
def _importable(spark):
    importable(spark)


def clustered(rng, n, groups=12, dims=64, spread=0.15):
    centre = rng.normal(size=(groups, dims))
    x = centre[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dims))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def embedding_rows(rng, n, hot=0):
    x = clustered(rng, n)
    x[:hot] = x[0]
    return [(i, x[i].tolist(), int(rng.integers(10))) for i in range(n)]


BAD = [(100000, None, 1), (100001, [0.1] * 63 + [None], 1), (100002, [0.1] * 63 + [float("nan")], 2),
       (100003, [float("inf")] + [0.1] * 63, 2), (100004, [0.1] * 5, 3), (100005, [], 3)]


# --- hard negatives ---------------------------------------------------------------

def brute_negatives(rows):
    kept = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, np.floor(256 * np.array(x, np.float32).astype(float)).astype(np.int64))
            for i, x, lab in rows if i is not None and lab is not None and x is not None and len(x) == 64
            and all(c is not None and np.isfinite(c) for c in x)]
    ids, labels = np.array([r[0] for r in kept]), np.array([r[1] for r in kept])
    x = np.array([r[2] for r in kept])
    out, seen = [], set()
    for a in range(len(kept)):
        if ids[a] % 100 or (ids[a], labels[a], tuple(x[a])) in seen:
            continue
        seen.add((ids[a], labels[a], tuple(x[a])))
        score = x @ x[a]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[a]]
        for p in [i for i in order if labels[i] == labels[a]][:5]:
            bad = [i for i in order if labels[i] != labels[a] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(int(ids[a]), int(ids[p]), k + 1, int(ids[i]), int(score[p]), int(score[i])) for k, i in enumerate(bad[:5])]
    return sorted(out)


@pytest.mark.parametrize("hot,options", [(0, {}), (0, {"leaf_rows": 40, "block_rows": 30, "fanout": 4}),
                                         (700, {"leaf_rows": 50, "block_rows": 64})])
def test_hard_negatives_equal_brute_force(spark, hot, options):
    rng = np.random.default_rng(5 + hot)
    rows = embedding_rows(rng, 1500, hot)
    rows += [(100, rows[100][1], rows[100][2]), (1492, rows[0][1], 4), (300, rows[7][1], 9)]  # repeated ids
    rows += BAD + [(None, rows[0][1], 1), (200100, rows[0][1], None)]
    df = spark.createDataFrame(rows, EMB).repartition(5).withColumn("key", F.lit("own")).withColumn("id", F.lit("own"))
    got = sorted(tuple(r) for r in gnat.hard_negatives(df, **options).collect())
    assert got == brute_negatives(rows)


def test_hard_negatives_empty_and_lonely(spark):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    none = gnat.hard_negatives(spark.createDataFrame([], EMB))
    assert none.columns == cols and none.collect() == []
    assert dict(none.dtypes)["rank"] == "int"
    one = spark.createDataFrame([(100, [0.1] * 64, 1)], EMB)
    assert gnat.hard_negatives(one).collect() == []


def test_components_too_large_to_be_exact_are_an_error(spark):
    big = spark.createDataFrame([(100, [1e9] + [0.0] * 63, 1), (101, [0.1] * 64, 1)], EMB)
    with pytest.raises(Exception, match="exact"):
        gnat.hard_negatives(big).collect()
    with pytest.raises(Exception, match="exact"):
        centroids.cluster(big).collect()


def test_ranges_hold_all_scores_and_prune_clustered_rows():
    rng = np.random.default_rng(3)
    x = np.floor(256 * clustered(rng, 4000, groups=20, spread=0.05).astype(float)).astype(np.int64)
    tree = gnat.build(x[:800], float((x * x).sum(axis=1).max()), len(x), fanout=5, leaf_rows=200)
    assert tree.leaves > 8
    leaf = gnat.descend(tree, x, ranges=True)
    q = x[::50]
    low, high = gnat.bounds(tree, q)
    score = q @ x.T
    for one in range(tree.leaves):
        inside = score[:, leaf == one]
        if inside.size:
            assert (inside.min(axis=1) >= low[:, one]).all() and (inside.max(axis=1) <= high[:, one]).all()
    fifth = np.sort(score, axis=1)[:, -6]
    assert (high < fifth[:, None]).mean() > 0.5  # most leaves cannot hold one of the five best


def test_products_are_exact_beyond_floating_point():
    a = np.full((2, 64), vectors.MAX_COMPONENT, np.int64)
    a[1, 0] -= 1
    assert vectors.products(a, a).tolist() == [[sum(int(p) * int(q) for p, q in zip(r, s)) for s in a] for r in a]


# --- centroid clustering ----------------------------------------------------------

def brute_clusters(rows, clusters=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in x]) for i, x, _ in rows
            if x is not None and len(x) == 64 and all(c is not None and np.isfinite(c) for c in x)]
    mark = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    first = sorted((r for r in kept if r[0] is not None), key=lambda r: (mark(r[0]), r[1]))
    cents = [list(r[1]) for r in (first + sorted(r for r in kept if r[0] is None))[:clusters]]
    x = np.array([r[1] for r in kept], dtype=object)

    def near():
        d = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents] for v in x]
        return [(row.index(min(row)), min(row)) for row in d]
    for _ in range(rounds):
        at = near()
        for k in range(len(cents)):
            own = [v for v, (c, _) in zip(x, at) if c == k]
            if own:
                cents[k] = [sum(col) // len(own) for col in zip(*own)]
    at = near()
    inertia = {k: sum(d for c, d in at if c == k) for k in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return [(r[0], c, d, inertia[c], sum(inertia.values()), sha[c]) for r, (c, d) in zip(kept, at)]


@pytest.mark.parametrize("n,hot", [(240, 0), (240, 150), (9, 0)])
def test_clusters_equal_brute_force(spark, n, hot):
    rows = embedding_rows(np.random.default_rng(n + hot), n, hot)
    rows += BAD + [(3, rows[3][1], 1), (3, rows[4][1], None), (None, rows[5][1], 1)]
    df = spark.createDataFrame(rows, EMB).repartition(4).withColumn("cluster", F.lit("own")).withColumn("x", F.lit(1))
    key = lambda r: tuple((v is None, v or 0) for v in r[:3])
    assert sorted((tuple(r) for r in centroids.cluster(df).collect()), key=key) == sorted(brute_clusters(rows), key=key)


def test_clusters_of_an_empty_table(spark):
    got = centroids.cluster(spark.createDataFrame(BAD, EMB))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got.collect() == []


def test_products_follow_nonzero_changes():
    rng = np.random.default_rng(1)
    x, c = rng.integers(-64, 64, (50, 8)), rng.integers(-64, 64, (5, 8))
    change = rng.integers(-3, 4, (5, 8)) * (rng.random((5, 8)) < 0.3)
    change[2] = 0
    assert (centroids.moved(x, x @ c.T, change) == x @ (c + change).T).all()


def test_rounds_leave_one_table_behind(spark):
    import os

    from riskweave.session import shared_path
    rows = embedding_rows(np.random.default_rng(0), 60)
    folder = shared_path(spark, "llm").removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    centroids.cluster(spark.createDataFrame(rows, EMB)).collect()
    left = [f for f in set(os.listdir(folder)) - before if f.startswith("centroids-")]
    assert len(left) == 1


# --- fingerprints -----------------------------------------------------------------

RANK = np.random.default_rng(2).permutation(digest.LEVELS + 1).astype(np.int64)


def plain_levels(data):
    out = []
    for p in range(len(data) - digest.FEATURE + 1):
        count = np.bincount(data[p:p + digest.FEATURE])
        out.append(((digest.LEVELS << 14) - int(digest._TERMS[count].sum())) >> 14)
    return out


def plain_selected(data, rank):
    """Neighbourhood by neighbourhood, the leftmost most improbable window wins."""
    lev = plain_levels(data)
    wins = [0] * len(lev)
    for t in range(-(digest.AREA - 1), len(lev)):
        area = range(max(0, t), min(len(lev), t + digest.AREA))
        wins[min(area, key=lambda p: (rank[lev[p]], p))] += 1
    return [p for p, w in enumerate(wins) if w >= digest.WINS]


def test_selection_equals_plain_search():
    rng = random.Random(4)
    texts = ["", "short", "x" * 31, "x" * 32, "ab" * 40, "é" * 50]
    texts += ["".join(rng.choice("abcdefgh  \n") for _ in range(rng.randint(30, 400))) for _ in range(30)]
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    at = digest.selected(np.concatenate(raw), off, RANK)
    for k, r in enumerate(raw):
        own = at[(at >= off[k]) & (at < off[k + 1])] - off[k]
        assert own.tolist() == (plain_selected(r, RANK) if len(r) >= digest.FEATURE else []), texts[k]


def test_a_row_s_fingerprint_does_not_depend_on_its_neighbours():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefg hij") for _ in range(n)) for n in (0, 5, 40, 3000, 33, 20000)]
    together = digest.fingerprints_of(texts, RANK)
    alone = [digest.fingerprints_of([t], RANK)[0] for t in texts]
    assert [digest.written_as(a) for a in together] == [digest.written_as(a) for a in alone]
    assert len(together[0]) == 0 and len(together[1]) == 1 and len(together[5]) > 3
    assert (digest.read_back(digest.written_as(together[5])) == together[5]).all()


def test_likeness_follows_shared_text():
    rng = random.Random(8)
    stock = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(stock) for _ in range(n))
    print_of = lambda t: digest.fingerprints_of([t], RANK)[0]
    for n in (60, 400, 4000):
        a, b = text(n), text(n)
        half = a[:len(a) // 2] + b[:len(a) // 2]
        most = a[:9 * len(a) // 10] + b[:len(a) // 10]
        same, alike, mixed, other = (digest.likeness(print_of(a), print_of(t)) for t in (a, most, half, b))
        assert same == 1.0 and same > alike > mixed > 0.25 and other < 0.1 and alike > 0.6
    none = print_of("")
    assert digest.likeness(none, none) == 1.0 and digest.likeness(none, print_of("word")) == 0.0


FP = "doc_id long, text string"


def check_edited(spark, rows, **options):
    df = spark.createDataFrame(rows, FP).repartition(6).withColumn("id", F.lit("own")).withColumn("range", F.lit(-1))
    got = digest.edited_fingerprints(df, **options).collect()
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    rank = digest.rarity(spark.createDataFrame(rows, FP).select("text"))
    prints = digest.fingerprints_of([t for _, t in ordered], rank)
    want = []
    for k, (i, t) in enumerate(ordered):
        after = (k + 1) % len(ordered)
        e = digest.edited(t, ordered[after][1])
        p = digest.fingerprints_of([e], rank)[0]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), digest.written_as(prints[k]), digest.written_as(p),
                     digest.likeness(prints[k], p), digest.likeness(prints[k], prints[after])))
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r) for r in got), key=key) == want


def test_edited_fingerprints_equal_brute_force(spark):
    rng = random.Random(9)
    rows = [(3 * i, "".join(rng.choice("abcdéf 日gh") for _ in range(rng.randint(0, 900)))) for i in range(400)]
    rows += [(5000, None), (5001, ""), (5002, "a"), (5003, "word " * 40000), (None, "no id"), (-7, "before all")]
    check_edited(spark, rows, range_rows=16)
    check_edited(spark, rows)


def test_edited_fingerprints_of_small_and_repeated_tables(spark):
    check_edited(spark, [(1, "only one document, its own next one")])
    check_edited(spark, [(None, "a text without an id")])
    assert digest.edited_fingerprints(spark.createDataFrame([], FP)).collect() == []
    rows = [(i % 3, f"text {i % 2} " * 20) for i in range(60)]
    got = digest.edited_fingerprints(spark.createDataFrame(rows, FP), range_rows=4).collect()
    assert len(got) == 60 and len({(r["n_chars"], r["fingerprint"]) for r in got}) == 2
    plain = digest.fingerprints(spark.createDataFrame([*rows, (9, None)], FP)).collect()
    assert len(plain) == 61 and {r["fingerprint"] for r in plain if r["doc_id"] == 9} == {""}


def test_rarity_counts_all_windows(spark):
    texts = ["".join(random.Random(i).choice("abcdefg ") for _ in range(200)) for i in range(20)] + [None, "", "z" * 100]
    rank = digest.rarity(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    count = np.zeros(digest.LEVELS + 1, int)
    for t in texts:
        for v in plain_levels(np.frombuffer((t or "").encode(), np.uint8)):
            count[v] += 1
    strong = np.arange(len(count)) >= digest.WEAK * digest.LEVELS / 5
    by = np.argsort(rank)
    assert (np.diff(count[by][strong[by]]) >= 0).all() and strong[by][:strong.sum()].all()
    assert pa.array(rank).null_count == 0 and sorted(rank) == list(range(len(rank)))
