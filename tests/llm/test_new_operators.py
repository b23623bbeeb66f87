"""Ranked search, centroid clustering and ball hashing against brute force, and their results on odd input."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from palimpsest.llm import ball_hashing, kmeans, ranked_search

TERM = re.compile("[0-9a-z\x80-\U0010FFFF]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x20\x09-\x0D]+")
# columns whose names the operators use inside
CLASH = "n long, term string, part int, item long, length double, id string, fingerprint string, fold int, sha string, v int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 0.5, "y", "z", 4, "s", 5) for i, t in rows], "doc_id long, text string, " + CLASH)


# --- op11 -----------------------------------------------------------------------------------------------
def terms(t):
    return TERM.findall((t or "").translate(LOWER))


def brute_ranking(docs, items, k=10):
    have = [(i, collections.Counter(terms(t))) for i, t in docs]
    have = [(i, c, sum(c.values())) for i, c in have if c]
    n_docs, n_terms = len(have), sum(n for _, _, n in have)
    df = collections.Counter(t for _, c, _ in have for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        scored = []
        for i, c, n in have:
            m = 25 + (75 * n * n_docs) // n_terms
            s = sum(w[t] * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def search_data():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)] + ["Éa", "ß9", "漢字"]
    pick = lambda n: " ".join(vocab[min(int(rng.paretovariate(0.7)) - 1, len(vocab) - 1)] for _ in range(n))
    items = [(i, pick(rng.randint(1, 25)).title()) for i in range(40)]
    docs = [(i * 2, pick(rng.choice([1, 5, 40, 300]))) for i in range(400)]
    docs += [(1001 + i, items[i % 40][1] + " " + pick(20)) for i in range(80)]
    docs += [(2000, None), (2001, ""), (2002, " .,\n"), (None, items[0][1]), (None, pick(30)), (7, docs[3][1]), (7, docs[3][1]), (2003, pick(20000))]
    return docs, items + [(50, None), (51, "--"), (52, "neverseen"), (0, "w1 w2"), items[3]]


@pytest.mark.parametrize("parts,part_chars", [(1, 1 << 20), (8, 1 << 20), (3, 2000)])
def test_ranked_search_equals_brute_force(spark, search_data, parts, part_chars):
    docs, items = search_data
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    got = ranked_search.rank_documents(documents(spark, docs).repartition(5), spark.createDataFrame(items, "item_id long, text string"), part_chars=part_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_ranking(docs, [x for x in items if x[1]])
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_ranked_search_without_rows(spark):
    none, some = documents(spark, []), documents(spark, [(1, "a b")])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    for d, i in ((none, items), (some, items.limit(0)), (documents(spark, [(1, None)]), items)):
        assert ranked_search.rank_documents(d, i).collect() == []
    assert [tuple(r) for r in ranked_search.rank_documents(some, items).collect()] == [(1, 1, 1, 287 * (10 ** 9 // 1800))]


def test_buckets_prune_and_lose_nothing():
    rng = np.random.default_rng(5)
    names = [f"t{i}" for i in range(200)]
    items = ranked_search.Items(list(range(30)), [" ".join(rng.choice(names, 12)) for _ in range(30)])
    items.weight = rng.integers(100, 9000, len(items.terms))
    items.n_docs, items.n_terms = 3000, 90_000
    vectors = []
    for i in range(3000):
        t = np.unique(np.concatenate((rng.choice(len(items.terms), 10), items.term[items.item == i % 30][:rng.integers(0, 12)])))
        vectors.append((i, t, items.impacts(t, rng.integers(1, 4, len(t)), np.full(len(t), 30))))
    vectors.sort(key=lambda v: -np.sqrt((v[2].astype(float) ** 2).sum()))
    best, scored = ranked_search.Best(30, 10, np.zeros(30, np.int64)), 0
    for lo in range(0, 3000, 100):
        part = vectors[lo:lo + 100]
        doc = np.repeat(np.arange(len(part)), [len(v[1]) for v in part])
        term, y = np.concatenate([v[1] for v in part]), np.concatenate([v[2] for v in part])
        length = np.sqrt(np.bincount(doc, y.astype(float) ** 2, minlength=len(part)))
        scored += ranked_search.search_bucket(items, best, np.array([v[0] for v in part]), doc, term, y, length)
    assert scored < 3000 * 30 / 3
    for q in range(30):
        count = dict(zip(items.term[items.item == q], items.count[items.item == q]))
        all_scores = sorted(((-sum(int(y) * count.get(t, 0) for t, y in zip(v[1], v[2])), v[0]) for v in vectors))[:10]
        mine = best.item == q
        assert sorted(zip(-best.score[mine], best.doc[mine])) == all_scores


# --- op12 -----------------------------------------------------------------------------------------------
def brute_clusters(rows, k, rounds, dim):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(c)), key=lambda j: (dist(v, c[j]), j))
    for _ in range(rounds):
        a = [near(v) for _, v in kept]
        c = [[sum(col) // a.count(j) for col in zip(*[v for (_, v), x in zip(kept, a) if x == j])] if j in a else c[j] for j in range(len(c))]
    a = [near(v) for _, v in kept]
    d = [dist(v, c[x]) for (_, v), x in zip(kept, a)]
    per = collections.Counter()
    for x, y in zip(a, d):
        per[x] += y
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted(((i, x, y, per[x], sum(d), sha[x]) for (i, _), x, y in zip(kept, a, d)), key=repr)


@pytest.mark.parametrize("n,k,rounds", [(300, 8, 10), (5, 8, 3), (60, 1, 2), (200, 5, 0)])
def test_clusters_equal_brute_force(spark, n, k, rounds):
    rng = random.Random(n)
    centre = [[rng.uniform(-1, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, 0.3) for x in centre[i % 4]]) for i in range(n)]
    rows += [(rows[0][0], rows[0][1])] * 3 + [(None, rows[1][1])] * 2 + [(900 + i, [0.0] * 6) for i in range(4)]  # copies, null ids, ties
    rows += [(800, None), (801, []), (802, [1.0] * 5), (803, [1.0] * 5 + [None]), (804, [float("nan")] * 6), (805, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<double>, a int, ids string, cluster int")
    got = kmeans.cluster_vectors(df.repartition(3), k=k, rounds=rounds, dim=6)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, k, rounds, 6)
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # blocks of earlier rounds are gone


def test_clusters_without_rows_and_out_of_range(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, None)], "vec_id long, embedding array<float>")
    assert kmeans.cluster_vectors(df, dim=64).collect() == []
    with pytest.raises(Exception, match="64 bits"):
        kmeans.cluster_vectors(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"), dim=64).collect()


def test_loosening_holds_for_points_of_the_sphere():
    rng = np.random.default_rng(1)
    tighter = 0
    for trial in range(300):
        dim = int(rng.integers(2, 6))
        old = rng.normal(0, 10, (5, dim))
        new = old + rng.normal(0, rng.choice([0.01, 1, 20]), (5, dim))
        radius = float(rng.choice([0.0, 1, 5, 30]))
        x = rng.normal(0, 1, (200, dim))
        x = old[2] + x / np.linalg.norm(x, axis=1, keepdims=True) * radius * rng.random((200, 1)) ** (1 / dim)
        nearer = np.linalg.norm(x[:, None] - old[None], axis=2) - np.linalg.norm(x[:, None] - new[None], axis=2)
        bound = kmeans.loosening(old, new, 2, radius)
        assert (nearer <= bound + 1e-9).all()
        drift = np.linalg.norm(new - old, axis=1)
        assert (bound <= drift * (1 + 1e-6)).all()
        tighter += (np.delete(bound, 2) < 0.9 * np.delete(drift, 2)).sum()
    assert tighter > 300


def test_bounds_spare_scans():
    rng = np.random.default_rng(2)
    centre = rng.normal(0, 900, (8, 16))
    x = np.floor(centre[rng.integers(0, 8, 4000)] + rng.normal(0, 150, (4000, 16))).astype(np.int32)
    c = np.floor(centre + rng.normal(0, 60, centre.shape)).astype(np.int64)
    a, upper, lower = kmeans.first_assignment(x, c)
    scans = []
    for _ in range(6):
        new = np.stack([x[a == j].sum(axis=0, dtype=np.int64) // max((a == j).sum(), 1) if (a == j).any() else c[j] for j in range(8)])
        a, upper, lower, scanned = kmeans.follow(x, a, upper, lower, c, new)
        c = new
        assert (a == kmeans.squared_distances(x, c).argmin(axis=1)).all()
        scans.append(scanned)
    assert sum(scans) < 0.25 * 6 * len(x)


# --- op13 -----------------------------------------------------------------------------------------------
def brute_print(text, k=4):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_fingerprints_equal_spark_and_brute_force(spark):
    rng = random.Random(4)
    alphabet = "aBc \t\n\r\x0b\x0c\x1cÉß漢"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 3, 30, 400]))) for _ in range(120)] + ["", None, "  ", "one", "a b c", "a b c d " * 50]
    got = ball_hashing.fingerprints_of(pa.array(texts, pa.string()))
    assert [int(x) for x in got] == [brute_print(t) for t in texts]
    sliced = pa.array(texts, pa.string()).slice(7, 40)
    assert [int(x) for x in ball_hashing.fingerprints_of(sliced)] == [brute_print(t) for t in texts[7:47]]
    h = spark.sql("SELECT xxhash64('a b c d') AS h").first()["h"]
    assert h & (1 << 64) - 1 == xxh64_intdigest(b"a b c d", 42)


def planted(seed, n):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(n)] + [0, 15, 31, (1 << 64) - 1]
    for base in prints[:n // 4]:
        for flips in (1, 3, 4, 5, 8):
            x = base
            for b in rng.sample(range(64), flips):
                x ^= 1 << b
            prints.append(x)
    return sorted(set(prints))


@pytest.mark.parametrize("radius", [4, 2, 0])
def test_links_within_the_radius(spark, radius, monkeypatch):
    monkeypatch.setattr(ball_hashing, "PART", 1 << 14)  # several parts on a few fingerprints
    prints = planted(radius, 160)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints + prints[:5]] + [(None,)], "fingerprint long")
    links = {tuple(v & (1 << 64) - 1 for v in r) for r in ball_hashing.links_within(df, radius).collect()}
    place = {x: i for i, x in enumerate(prints)}
    label = list(range(len(prints)))
    for a, b in links:
        x, y = label[place[a]], label[place[b]]
        label = [min(x, y) if v in (x, y) else v for v in label]
    assert label == components(prints, radius)
    with pytest.raises(ValueError):
        ball_hashing.links_within(df, 3)


def test_meetings_in_turns_find_the_same():
    prints = np.array(planted(9, 120), np.uint64)
    whole = ball_hashing.forest(ball_hashing.meetings(prints, 0, 0, 2, 4))
    turns = ball_hashing.forest(ball_hashing.meetings(prints, 0, 0, 2, 4, most=50_000))
    assert len(whole) and np.array_equal(whole, turns)
    parts = [ball_hashing.meetings(prints, p, 5, 2, 4) for p in range(32)]  # each part with all fingerprints finds its share
    assert np.array_equal(ball_hashing.forest(np.concatenate(parts)), whole)


def test_a_large_group_of_near_copies_spreads(spark):
    rng = random.Random(8)
    centre, group = rng.getrandbits(64), set()
    while len(group) < 4000:
        x = centre
        for b in rng.sample(range(64), 6):
            x ^= 1 << b
        group.add(x)
    sizes = np.bincount(ball_hashing.fold(np.array(sorted(group), np.uint64), 10), minlength=1024)
    assert sizes.max() < 4000 / 20


def test_near_copies_of_documents(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(12)]
    texts = [*base, *[b.replace(b.split()[9], "edited", 1) for b in base], base[0].upper(), base[0], "", None, " \n", "short", "SHORT"]
    rows = [(i * 5 + 3, t) for i, t in enumerate(texts)] + [(3, base[4]), (None, base[5]), (None, "alone again")]
    got = ball_hashing.near_copies(documents(spark, rows).repartition(4)).collect()
    assert len(got) == len(rows)
    prints = [brute_print(t) for _, t in rows]
    label = components(prints, 4)
    key = lambda i: (i is not None, i or 0)
    low = {c: min((rows[j][0] for j in range(len(rows)) if label[j] == c), key=key) for c in set(label)}
    want = [(i, f"{p:016x}", low[c]) for (i, _), p, c in zip(rows, prints, label)]
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert ball_hashing.near_copies(documents(spark, [])).count() == 0


def test_fold_in_columns(spark):
    values = [0, 1, -1, 1 << 62, 123456789, -(1 << 63)]
    for bits in (0, 1, 7, 16, 32):
        got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x long").select(ball_hashing.fold_column(F.col("x"), bits)).collect()]
        assert got == ball_hashing.fold(np.array(values, np.int64).view(np.uint64), bits).tolist()
