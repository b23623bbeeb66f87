"""Retrieval and models recomputed from scratch, and the pipeline's stages on odd tables."""

import collections
import math
import random
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from palimpsest.llm import decontaminate, linear, mixing, quality, simhash, toxicity

TOKEN = re.compile("[0-9a-z\x80-\U0010FFFF]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(t):
    return TOKEN.findall((t or "").translate(LOWER))


def pairs(w):
    return set(zip(w, w[1:])) if len(w) > 1 else {(x,) for x in w}


def brute_leaks(docs, items):
    """Exact BM25 of every window against every item, then the overlaps."""
    clean = sorted({(i, t) for i, t in items if words(t)})
    df = collections.Counter(w for _, t in clean for w in set(words(t)))
    mean = sum(len(words(t)) for _, t in clean) / len(clean)
    classes = collections.defaultdict(list)
    for i, t in clean:
        classes[max(6, (len(words(t)) - 1).bit_length())].append((i, t))
    out = set()
    for group in classes.values():
        cell = max(len(words(t)) for _, t in group)
        for doc, text in docs:
            w = words(text)
            for lo in range(0, max(1, -(-len(w) // cell) - 1) * cell, cell):
                here = w[lo:lo + 2 * cell]
                seen, both = set(here), pairs(here) | {(x,) for x in here}
                for i, t in group:
                    tf, n = collections.Counter(words(t)), len(words(t))
                    weight = {x: math.log(1 + (len(clean) - df[x] + 0.5) / (df[x] + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * n / mean)) for x, c in tf.items()}
                    if sum(v for x, v in weight.items() if x in seen) < 0.6 * sum(weight.values()):
                        continue
                    q, a = (words(x) or words(t) for x in decontaminate.sides(t))
                    if all(len(pairs(x) & both) >= 0.6 * len(pairs(x)) for x in (q, a)):
                        out.add((doc, i))
    return out


def test_leaks_equal_exact_search(spark):
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(150)]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, f"{line(rng.choice([3, 8, 30, 90]))}. {line(rng.choice([2, 6]))}") for i in range(40)] + [(50, line(9)), (51, None), (52, "."), (3, line(12))]
    docs = [(i, line(rng.choice([0, 5, 60, 400]))) for i in range(60)]
    for i in range(120):  # whole items, items with words changed or cut off, at any place
        w = items[rng.randrange(40)][1].split()
        for _ in range(rng.choice([0, 0, 1, 3, len(w) // 3])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        docs.append((100 + i, f"{line(rng.randrange(80))} {' '.join(w[:rng.choice([len(w), len(w) * 2 // 3])])} {line(rng.randrange(80))}"))
    docs += [(900, None), (901, ""), (100, docs[60][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_leaks(docs, items)
    assert 30 < len(want) < 400
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(d.repartition(5), bench).collect()} == want
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(d, bench).collect()) == sorted(i for i, _ in docs if i not in {x for x, _ in want})


# --- op5 ------------------------------------------------------------------------------------------------
def brute_simhash(text):
    ws = [w for w in re.split("[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    h = [xxh64_intdigest(w.encode(), 42) for w in ws]
    votes, total = [0] * 64, 0
    for i, w in enumerate(ws):
        x = 42
        for y in h[i:i + 3]:
            x = xxh64_intdigest(struct.pack("<Q", y), x)
        weight = min(len(w), 7)
        total += weight
        for b in range(64):
            votes[b] += weight * (x >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def test_fingerprint_bits_and_likeness(spark):
    rng = random.Random(12)
    texts = [" ".join("".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(rng.choice([1, 2, 3, 40, 200]))) for _ in range(25)]
    texts += ["", None, "A b", "a B"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in simhash.fingerprint_documents(docs).collect():
        t, nxt = texts[r.doc_id] or "", texts[(r.doc_id + 1) % len(texts)] or ""
        k = len(t) // 4
        a, e = brute_simhash(t), brute_simhash(t[:len(t) - k] + nxt[:k])
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (a, e), r.doc_id
        assert r.near_edited == 1 - (a ^ e).bit_count() / 64 and r.near_next == 1 - (a ^ brute_simhash(nxt)).bit_count() / 64


def test_a_third_of_rows_without_id(spark):
    rng = random.Random(13)
    rows = [(None if i % 3 == 0 else i, " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randint(1, 60))), "s") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = simhash.fingerprint_documents(docs).collect()
    assert len(out) == 900
    assert sorted(int(r.fingerprint, 16) for r in out) == sorted(brute_simhash(t) for _, t, _ in rows)
    mixed = mixing.mix_sources(docs, (3, 1, 2)).collect()
    assert sum(r["size"] for r in mixed) == sum(len(t.split()) for _, t, _ in rows) and len(mixed) == 900
    # rows without id queue all over their source, not in one place
    queued = sorted((r.mix_offset, r.doc_id is None) for r in mixed if r.mix_offset is not None)
    longest = max(len(list(g)) for g in "".join("n" if n else "." for _, n in queued).split("."))
    assert longest < 15


# --- op6, op10 ------------------------------------------------------------------------------------------
def sparse(rng, n, size):
    f = [np.unique(rng.integers(0, size, rng.integers(0, 9))) for _ in range(n)]
    return f, [rng.random(len(x)) for x in f]


def dense(f, v, size):
    m = np.zeros((len(f), size))
    for i, (a, b) in enumerate(zip(f, v)):
        m[i, a] = b
    return m


def by_differences(loss, p, at):
    step = 1e-5
    out = []
    for i in at:
        d = np.zeros(len(p))
        d[i] = step
        out.append((loss(p + d) - loss(p - d)) / (2 * step))
    return np.array(out)


def test_ordinal_gradient():
    rng = np.random.default_rng(3)
    size, n, cuts = 12, 40, 3
    f, v = sparse(rng, n, size)
    k, m = rng.integers(0, cuts + 1, n), dense(f, v, size)

    def loss(p):
        th = np.concatenate(([-np.inf], np.cumsum(np.concatenate((p[size:size + 1], np.exp(p[size + 1:])))), [np.inf]))
        z = m @ p[:size]
        cdf = lambda x: 1 / (1 + np.exp(-x))
        return (-np.log(cdf(th[k + 1] - z) - cdf(th[k] - z)).sum() + 0.25 * (p[:size] ** 2).sum()) / n
    p = rng.normal(0, 0.5, size + cuts)
    got = quality.gradient_of(linear.Sparse(f, v), k, cuts, size, 0.5, np.ones(size))(p)
    assert np.allclose(got, by_differences(loss, p, range(len(p))), atol=1e-7)


def test_toxicity_gradient():
    rng = np.random.default_rng(4)
    size, n = 15, 30
    f, _ = sparse(rng, n, size)
    g, _ = sparse(rng, 9, size)
    y = rng.integers(0, 2, n).astype(float)
    ones = lambda x: [np.ones(len(a)) for a in x]
    m, own, swapped = dense(f, ones(f), size), dense(f[:9], ones(f[:9]), size), dense(g, ones(g), size)

    def loss(p):
        z = m @ p[:-1] + p[-1]
        return (np.logaddexp(0, z) - y * z).sum() / n + (0.5 * (p[:-1] ** 2).sum() + 7 * (((own - swapped) @ p[:-1]) ** 2).sum()) / n
    p = rng.normal(0, 0.5, size + 1)
    got = toxicity.gradient_of(linear.Sparse(f), y, linear.Sparse(f[:9]), linear.Sparse(g), size, 7.0, 1.0)(p)
    assert np.allclose(got, by_differences(loss, p, range(len(p))), atol=1e-7)


def labelled(spark, n=150):
    rng = random.Random(14)
    rows = [(i, " ".join(rng.choice(["calm", "river", "stone"] + (["vile"] * 3 if i % 3 == 0 else [])) for _ in range(10))) for i in range(n)]
    labels = [(i, int(i % 2 == 0), int(i % 3 == 0)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_scores_follow_from_weights(spark):
    rows, docs, labels = labelled(spark)
    more = docs.union(spark.createDataFrame([(7, "vile stone"), (7, "vile stone"), (900, None), (901, "")], docs.schema))
    model = toxicity.train(docs, toxicity.toxic_labels(labels))
    weight = dict(zip(model["features"].tolist(), model["weights"]))
    import pyarrow as pa
    for r in toxicity.score(more, model, ["doc_id", "text"]).collect():
        _, f, _ = linear.word_presence(pa.array([r.text or ""]))
        z = model["bias"] + sum(weight.get(x, 0.0) for x in f.tolist())
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9
    w, th, grades = quality.train(docs, quality.graded(labels))
    for r in quality.rate(more, (w, th, grades), 1, ["doc_id", "text"]).collect():
        _, f, v = linear.word_rates(pa.array([r.text or ""]))
        z = float((w[f].astype(np.float32) * v).sum())
        below = [1 / (1 + math.exp(-(t - z))) for t in th] + [1.0]
        p = np.diff([0.0, *below])
        assert abs(r.expected_grade - p @ grades) < 1e-4 and abs(r.tail_prob - p[grades >= 1].sum()) < 1e-4


def test_the_bound_holds_for_a_repeated_id(spark):
    rows = [(7, f"text {i}") for i in range(3000)] + [(i, "x") for i in range(100, 400)] + [(None, "no id")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i, 0) for i in range(100, 400)], "doc_id long, y int")
    sample = linear.labelled_sample(docs, labels, 100, "doc_id", "text").collect()
    assert 40 <= len(sample) <= 160
    whole = linear.labelled_sample(docs, labels, 1000, "doc_id", "text").collect()
    assert len(whole) == 301 and sum(r.y for r in whole) == 1


# --- stages ---------------------------------------------------------------------------------------------
EXTRA = ["size", "Taken", "target", "mix_offset", "source_size", "_id", "_t", "_all", "_row", "_key", "_own", "doc_size"]


@pytest.fixture()
def small_tables(spark, tmp_path):
    rows, _, labels = labelled(spark, 60)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "what is the tall thing over there. it is a tower.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    spark.createDataFrame([], labels.schema).write.parquet(f"{tmp_path}/none/labels.parquet")
    docs = [(i, f"{i} " + t, "en", f"s{i % 3}", 1) for i, t in rows]
    docs += [(500, None, None, None, 0), (501, "", "en", "s1", 0), (501, "", "en", "s1", 0), (None, "an other text of no id", "en", None, 9), (3, "third text again with other words", "en", "s2", 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return str(tmp_path), frame.select("*", *[F.lit(f"own {c}").alias(c) for c in EXTRA])


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_tables(spark, small_tables, tmp_path, stage):
    folder, docs = small_tables
    name, run = corpus_pipeline.STAGES[stage]
    for k, (d, tables) in enumerate([(docs, folder), (docs.limit(0), folder), (docs, f"{folder}/none")]):
        out = run(spark, d, tables)
        out.write.parquet(f"{tmp_path}/out{k}")  # no two columns of one name
        got = spark.read.parquet(f"{tmp_path}/out{k}")
        assert got.count() <= d.count() and (k != 1 or got.count() == 0)
        if stage < 4:
            assert got.columns == docs.columns, name
        else:
            assert {*corpus_pipeline.MIX_COLUMNS, "doc_Taken", "_doc_size"} <= set(got.columns)
        for c in EXTRA:
            kept = c if stage < 4 or c.lower() not in corpus_pipeline.MIX_COLUMNS else "_doc_size" if c == "size" else f"doc_{c}"
            assert {r[0] for r in got.select(kept).distinct().collect()} <= {f"own {c}"}
        if k == 2 and stage in (0, 3):
            assert got.count() == docs.count()  # nothing is toxic, nothing leaks
        if k == 0 and stage < 4:
            assert got.where("doc_id IS NULL OR doc_id IN (500, 501)").count() == 4  # null, empty (twice) and id-less texts stay


def test_pipeline_leaves_one_stage_behind(spark, workdir):
    import glob
    import os
    from palimpsest.session import ensure_checkpoint_dir
    before = set(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/pipeline-*"))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    (folder,) = set(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/pipeline-*")) - before
    assert os.listdir(folder) == [str(len(corpus_pipeline.STAGES) - 2)]
