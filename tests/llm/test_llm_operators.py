"""Training-data operators against brute force on small tables, and their results on odd input."""

import collections
import hashlib
import math
import random
import re
import textwrap
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from palimpsest.llm import (decontaminate, hashed, jaccard, langid, license_scan, linear, mixing, quality, simhash,
                            suffix_dedup, toxicity, url_filter)

WORD = re.compile("[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, `key` string, n int, c string"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", "y", "z", 7, "w") for i, t, lang, s in rows], DOC)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    names = ["".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(names) for _ in range(n))
    base = [prose(rng.randint(20, 260)) for _ in range(40)]
    near = []
    for b in base[:8]:
        w = b.split()
        for _ in range(3):
            v = list(w)
            for _ in range(max(1, len(v) // 60)):
                v[rng.randrange(len(v))] = "edited"
            near.append(" ".join(v))
    shared = prose(90)
    mid = [f"{prose(30)} {shared} {prose(30)}" for _ in range(6)]
    return [*base, *near, *mid, base[3], base[3], "", None, "one", "Ones two", "ß é 漢字 " * 30, "ab " * 400, "long " + prose(9000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    src = ["a", "b", None, "a", "a", "B", "a"]
    rows = [(i * 3, t, "en", src[i % 7]) for i, t in enumerate(texts)]
    return frame(spark, rows).repartition(4).cache()


def test_mix_meets_targets_and_repeats(spark, docs, texts):
    out = mixing.mix_sources(docs, (3, 1, 2)).collect()
    again = mixing.mix_sources(docs.repartition(3), (3, 1, 2)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again)) and len(out) == len(texts)
    size = {i * 3: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    by, taken, target = collections.Counter(), collections.Counter(), {}
    for r in out:
        assert r["size"] == size[r.doc_id] and r.taken <= 2 * r["size"]
        by[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    order = sorted([s for s in by if s is not None]) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, want = 1.5 * sum(by.values()), set(order), {}
    while open_:  # deal by weight, cap, deal the excess again
        deal = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if deal[s] > 2 * by[s]]
        if not full:
            want |= deal
            break
        for s in full:
            want[s] = 2 * by[s]
            left -= want[s]
            open_.remove(s)
    for s in order:
        assert by[s] == next(r.source_size for r in out if r.source == s)
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - target[s]) <= 1


def rule_of(host, path, rules):
    fit = [(len(r), len(r.split("/")[0]), v, r) for v, r in rules
           if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return max(fit, default=None)


def test_url_rules(spark):
    rng = random.Random(1)
    rules = [("allow", "org/"), ("block", "a.org/x/"), ("allow", "a.org/x/y"), ("block", "b.a.org/"), ("block", "com/x"),
             ("allow", "com/x"), ("allow", "net/\U0010FFFF"), ("block", "a.org/é")]
    hosts = ["org", "a.org", "A.Org", "b.a.org", "c.b.a.org", "xa.org", "com", "q.com", "a.net", "", "org.com"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/x/yz", "/x/z", "/é", "/\U0010FFFFa", "/X"]
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/x/', '#/x'])}") for i in range(400)]
    rows += [(1000, None), (1001, "a.org/x/"), (1002, ""), (1002, "http://a.org/x/"), (1002, "http://a.org/x/"), (None, "x://y://z")]
    rows += [(2000 + i, "http://hot.a.org/x/y") for i in range(300)]
    out = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)), rules).collect()
    want = []
    for i, u in rows:
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        r = rule_of(host, path, rules)
        want.append((i, host, path, r and r[3], r[2] if r else "allow"))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_license_texts(spark):
    mit = license_scan.KNOWN_LICENSES[0][1]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,"), "en", None), (2, "released under the MIT Licence!", "en", None),
            (3, "prose\nReleased under the MIT License.\r\nLicensed under CC BY 4.0", "en", None), (4, None, None, None), (5, "...", None, None), (5, "...", None, None)]
    out = {r.doc_id: r for r in license_scan.with_license_lines(license_scan.scan_licenses(frame(spark, rows))).collect()}
    assert [out[i].license for i in (1, 2, 3, 4, 5)] == ["MIT", "MIT", None, None, None]
    assert (out[3].license_lines, out[3].line_licenses, out[2].license_lines) == (2, "CC-BY-4.0|MIT", 1)


def test_license_texts_at_any_width(spark):
    texts = license_scan.KNOWN_LICENSES[:15]
    rows = [(name, textwrap.fill(" ".join(t.split()), width)) for name, t in texts for width in (20, 40, *range(66, 81), 100, 10 ** 6)]
    rows += [(name, f"{n}\n\n{textwrap.fill(t, 78)}") for name, t in texts[:1] for n in (
        "Copyright (c) Some One", "# COPYRIGHT 2019-2021 Some One", "Copyright © 2020", "© Some One", "(c) 2020 Some One", "Copyright Joyent, Inc. and others",
        "Copyright The Go Authors", "Copyright by Some One", "copyright Notable Ltd", "Copyright Hold", "Copyright Émile")]
    out = license_scan.scan_licenses(frame(spark, [(i, t, None, None) for i, (_, t) in enumerate(rows)])).collect()
    assert not [(rows[r.doc_id], r.license) for r in out if r.license != rows[r.doc_id][0]]
    lines = ["copyright notice and so on", "Copyright holders be", "copyright holder", "(c) You must retain", "copyright license.", "copyright", "copyright the software, and"]
    kept = spark.createDataFrame([(x,) for x in lines], "t string").select("t", license_scan.canonical(F.col("t")).alias("c")).collect()
    assert all(r.c == " ".join(re.findall(r"\w+", r.t.lower())) for r in kept)


def test_whole_license_texts(spark):
    whole = license_scan.KNOWN_LICENSES[15:]
    assert {n for n, _ in whole} >= {"Apache-2.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "GFDL-1.3", "CC0-1.0"}
    rows = [*whole, *((n, f"Copyright (c) 2021 Some One\r\n\r\n{t.upper()}".replace("\n", "\r\n")) for n, t in whole)]
    rows += [(n, textwrap.fill(" ".join(t.split()), width)) for n, t in whole if n in ("Apache-2.0", "BSD-3-Clause", "CC0-1.0", "MPL-2.0") for width in (40, 72, 79)]
    rows += [(None, t[:len(t) // 2]) for _, t in whole]
    out = license_scan.scan_licenses(frame(spark, [(i, t, None, None) for i, (_, t) in enumerate(rows)])).collect()
    assert not [(rows[r.doc_id][0], r.doc_id, r.license) for r in out if r.license != rows[r.doc_id][0]]


def test_leaks(spark, docs, texts):
    items = [(1, "dala muri golo pake tiru semo. Nalo keru pido sami tole buna gade."), (2, "x"), (3, None), (4, "..."), (1, "other item of the same id but more words in it."),
             (5, " ".join(f"w{i}" for i in range(200)) + ". The answer is w3.")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    more = frame(spark, [(9000, f"{texts[0]} {items[0][1].upper()} {texts[1]}", None, None), (9001, f"{texts[2]} {items[5][1]}", None, None),
                         (9002, texts[0] + " dala muri golo pake tiru semo. " + texts[1], None, None)])
    both = docs.union(more)
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(both, bench).collect()}
    assert found == {(9000, 1), (9001, 5)}
    kept = decontaminate.drop_leaks(both, bench)
    assert kept.columns == docs.columns and kept.count() == both.count() - 2
    split = decontaminate.build_indexes(bench, part_chars=60)  # many parts give what one gives
    assert sum(len(i.ids) for part in split for i in part) == 4


def test_fingerprints(spark, docs, texts):
    out = {r.doc_id: r for r in simhash.fingerprint_documents(docs).collect()}
    assert len(out) == len(texts)
    fp = {i: int(r.fingerprint, 16) for i, r in out.items()}
    for i, t in enumerate(texts):
        t, nxt, r = t or "", texts[(i + 1) % len(texts)] or "", out[i * 3]
        k = len(t) // 4
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest())
        assert r.near_next == 1 - bin(fp[i * 3] ^ fp[(i + 1) % len(texts) * 3]).count("1") / 64
        assert r.n_near == (sum(bin(fp[i * 3] ^ x).count("1") <= 3 for x in fp.values()) if i * 3 % 100 == 0 else None)
    assert out[9].fingerprint == out[3 * (40 + 24 + 6)].fingerprint


def test_radius_search_is_complete(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    near = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(6)]
    every = [x - (1 << 64) if x >> 63 else x for x in {*base, *near}]
    t = spark.createDataFrame([(x,) for x in every + every[:9]], "fingerprint long")
    got = simhash.within_radius(t, t, 3).collect()
    want = {(a, b) for a in every for b in every if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def removed(raw, length):
    count = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    for b in raw:
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                mask[i:i + length] = b"\1" * length
        yield mask


@pytest.mark.parametrize("length,core", [(400, 200), (60, 30), (24, 8)])
def test_repeated_strings(spark, docs, texts, length, core):
    out = {r.doc_id: r for r in suffix_dedup.removal_report(docs, length, core).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (b, mask) in enumerate(zip(raw, removed(raw, length))):
        kept = bytes(x for x, m in zip(b, mask) if not m)
        spans = len(re.findall(b"\1+", bytes(mask)))
        r = out[i * 3]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest()), i


def test_planted_passages_go_from_400_bytes(spark):
    rng = random.Random(12)
    word = lambda k: "".join(rng.choice("abcdefghijk") for _ in range(k))
    line = lambda n: " ".join(word(rng.randint(2, 9)) for _ in range(n))
    rows, want = [], {}
    for size in (399, 400, 401, 700):
        passage = " ".join(word(6) for _ in range(56)) + " "
        passage += word(size - len(passage))
        assert len(passage) == size and len(WORD.findall(passage)) > 50
        # no two places have the same neighbours, so nothing longer repeats
        for before, after in (("", f"A {line(60)}"), (f"{line(60)} B", f"B {line(60)}"), (f"{line(60)} C", "")):
            rows.append(before + passage + after)
            want[len(rows)] = (size, 1, before + after) if size >= 400 else (0, 0, rows[-1])
    for _ in range(12):  # clean ones
        rows.append(line(150))
        want[len(rows)] = (0, 0, rows[-1])
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(rows, 1)]).repartition(3)
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(docs).collect()}
    assert got == {i: (n, k, hashlib.sha256(t.encode()).hexdigest()) for i, (n, k, t) in want.items()}


def without_runs(texts, n):
    """Texts without the words covered by runs of ``n`` words that start anywhere else too, as lists of words."""
    words = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    for w in words:
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        yield [x for j, x in enumerate(w) if j not in gone]


def test_repeated_runs_of_words(spark, texts):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(1, 5)))
    line = lambda n: " ".join(word() for _ in range(n))
    short, fifty, tiny = line(51), line(50), " ".join(rng.choice("abcdefgh") for _ in range(51))
    assert max(len(short), len(tiny)) < 400
    planted = [f"{line(40)} {p} {line(40)}" for p in (short, short, fifty, fifty, tiny, tiny)]
    planted += [f"{line(30)}\n{short}", f"{short}\n\n{line(30)}", f" {short} ", short.replace(" ", "\n"), "é " + line(9), None]
    rows = [(i if i % 3 else None, t, "en", "s") for i, t in enumerate(planted)]
    got = suffix_dedup.remove_repeats(frame(spark, rows).repartition(3), words=corpus_pipeline.REPEATED_WORDS).collect()
    want = list(without_runs(planted, 51))
    left = sorted(WORD.findall(r.text or "") for r in got)
    assert left == sorted(w for w, t in zip(want, planted) if w or not t)
    assert sum(fifty in r.text for r in got if r.text) == 2 and not any(short in r.text or tiny in r.text for r in got if r.text)
    # strings of 400 bytes go as before, also where they have few words
    long = "".join(rng.choice("abcdefgh") for _ in range(450))
    got = suffix_dedup.remove_repeats(frame(spark, [(i, f"{i} {long} {i}{i}", None, None) for i in range(2)]), words=51).collect()
    assert not any(long in r.text for r in got)
    # texts with many repeats, whose copies overlap
    few = [t for t in texts if len(t or "") < 5000]
    got = suffix_dedup.remove_repeats(frame(spark, [(i, t, None, None) for i, t in enumerate(few)]).repartition(3), 1 << 20, 1 << 19, words=12).collect()
    want = {i: w for i, w in enumerate(without_runs(few, 12))}
    assert {r.doc_id: WORD.findall(r.text) for r in got} == {i: w for i, w in want.items() if w or not few[i]}


def components(texts, k, percent):
    sets = []
    for t in texts:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return [len(s) for s in sets], root


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_jaccard_components(spark, docs, texts, k, percent, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 4)
    n, root = components(texts, k, percent)
    out = {r.doc_id: r for r in jaccard.jaccard_components(docs, k, percent).collect()}
    assert [(out[i * 3].n_shingles, out[i * 3].component_id) for i in range(len(texts))] == [(a, b * 3) for a, b in zip(n, root)]
    if k == 5:
        assert sorted(r.doc_id for r in jaccard.one_per_component(docs).collect()) == sorted({r * 3 for r in root})


def test_texts_that_share_lines_by_chance_are_not_opened(spark, monkeypatch):
    rng = random.Random(4)
    line = lambda n=9: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    common = [line() for _ in range(12)]
    texts = [" ".join((*rng.sample(common, 2), line())) for _ in range(300)]  # half of each is shared, with no other the same half
    texts += [t + " more" for t in texts[::10]]
    held, cut = [], jaccard.cut_lineage
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def seen(df):
        out = cut(df)
        if out.columns == ["xu", "yu"]:
            held.append(out.where("xu < yu").count())
            assert spark.conf.get(key) == "true"  # else shuffle files stay until the driver collects its garbage
        return out
    monkeypatch.setattr(jaccard, "cut_lineage", seen)
    monkeypatch.setattr(jaccard, "BUNDLE", 1 << 12)
    before = spark.conf.get(key, None)
    out = jaccard.jaccard_components(frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]).repartition(3)).collect()
    assert held == [0]
    assert spark.conf.get(key, None) == before
    n, root = components(texts, 4, 85)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out) == list(zip(range(len(texts)), n, root))
    assert sum(r != i for i, r in enumerate(root)) == 30


def test_one_of_each_component_whatever_the_ids(spark):
    rng = random.Random(9)
    line = lambda n=40: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    copied, a, b = line(60), line(), line()
    near = copied + " more"
    rows = [(1, copied, "en", "s"), (2, near, "en", "s"), (2, a, "en", "s"), (2, b, "en", "s"), (2, b, "en", "s"), (2, b, "de", "s"),
            *[(None, line(), "en", f"s{i % 2}") for i in range(6)], (None, near, "en", "s"), (7, "", "en", "s"), (8, " ", "en", "s")]
    docs = frame(spark, rows)
    kept = jaccard.one_per_component(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted((repr(r.doc_id), r.text) for r in kept.collect())
    # the near copy with a null id comes first in its component
    want = [(2, a), (2, b), *[r[:2] for r in rows[6:12]], (None, near), (7, ""), (8, " ")]
    assert got == sorted((repr(i), t) for i, t in want)
    again = sorted((repr(r.doc_id), r.text) for r in jaccard.one_per_component(docs.orderBy(F.desc("text")).repartition(2)).collect())
    assert again == got
    twice = kept.union(kept.where("doc_id = 2")).cache()  # equal rows too
    out = corpus_pipeline.mix(spark, twice, "").collect()
    plain = mixing.mix_sources(twice, weights=(3, 1, 2), share=1.5, most=2).where("taken > 0").collect()
    assert sorted((repr(r.doc_id), r["size"], r.taken) for r in out) == sorted((repr(r.doc_id), r["size"], r.taken) for r in plain)
    assert all(r["size"] == len(r.text.split()) for r in out)
    assert {(repr(r.doc_id), r.text) for r in out if r.doc_id == 2} <= {(repr(i), t) for i, t in want}


@pytest.mark.parametrize("cells", [16, 64, 1 << 20])
def test_links_in_blocks(cells, monkeypatch):
    monkeypatch.setattr(jaccard, "CELLS", cells)
    rng = np.random.default_rng(1)
    for turn in range(100):
        m = int(rng.integers(2, 14))
        left = int(rng.integers(0, m)) if turn % 2 else 0
        sets = [np.unique(rng.integers(0, 9, rng.integers(3, 12))).astype(np.uint64) for _ in range(m)]
        label = list(range(m))
        for i in range(m):
            for j in range(i + 1, m):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if (not left or i < left <= j) and 100 * len(a & b) >= 60 * len(a | b):
                    low, high = sorted((label[i], label[j]))
                    label = [low if x == high else x for x in label]
        assert jaccard.linked(sets, left, 60).tolist() == label


@pytest.mark.parametrize("left", [0, 1500])
def test_links_of_many_short_texts_in_little_memory(left, monkeypatch):
    monkeypatch.setattr(jaccard, "CELLS", 1 << 16)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 40, 10)).astype(np.uint64) for _ in range(3000)]
    sets[2000], sets[2900] = sets[7], sets[1400]
    tracemalloc.start()
    got = jaccard.linked(sets, left, 85)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.flatnonzero(got != np.arange(3000)).tolist() == [2000, 2900] and (got[2000], got[2900]) == (7, 1400)
    assert peak < 1500 * 1500 * 4


def test_language_from_pieces(spark):
    rng = random.Random(2)
    words = {"aa": ["the", "thing", "ing", "and"], "bb": ["der", "ung", "schein", "und"]}
    rows = [(i, " ".join(rng.choice(words[g]) + rng.choice(words[g]) for _ in range(30)), g, None) for i in range(60) for g in [("aa", "bb")[i % 2]]]
    rows += [(100, None, "aa", None), (101, "123 ...", "aa", None), (102, "", None, None), (103, "thingthe " * 4000, None, None), (103, "w" * 300, None, None)]
    out = langid.identify_documents(frame(spark, rows)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r.lang_pred for r in out if r.doc_id != 103}
    assert all(got[i] == g for i, _, g, _ in rows[:60]) and {got[100], got[101], got[102]} == {"und"}
    assert langid.identify_documents(frame(spark, rows).where("doc_id < 0")).count() == 0


@pytest.fixture()
def small_vocabulary():
    pieces = sorted({b" a", b"ab", b"b", b"abc", b"Ab", b"abcababcababcababcab", b" abcabab"} | {bytes([x]) for x in range(256)})
    prob = np.linspace(0.001, 0.004, len(pieces))
    return pieces, prob, {"pieces": langid.Pieces(pieces), "langs": ["x"], "prob": np.append(prob, 0)[:, None]}


def all_segmentations(s, pieces, prob):
    """Log of the sum over all segmentations, and the expected count of each piece, with fractions of any size."""
    from fractions import Fraction
    place = {p: Fraction(float(prob[i])) for i, p in enumerate(pieces)}
    spans = [(i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1) if s[i:j] in place]
    ahead, behind = [Fraction(0)] * len(s) + [Fraction(1)], [Fraction(1)] + [Fraction(0)] * len(s)
    for i, j in sorted(spans, key=lambda x: x[1]):
        behind[j] += behind[i] * place[s[i:j]]
    for i, j in sorted(spans, reverse=True):
        ahead[i] += place[s[i:j]] * ahead[j]
    count = collections.Counter()
    for i, j in spans:
        count[s[i:j]] += behind[i] * place[s[i:j]] * ahead[j] / ahead[0]
    top = behind[-1]
    return math.log(top.numerator) - math.log(top.denominator), {k: float(v) for k, v in count.items()}


@pytest.mark.parametrize("word", ["abcab", "Abab", "abc" + "abcab" * 7, "abcab" * 60, "漢字abcab", "x"])
def test_forward_sums_all_segmentations(small_vocabulary, word):
    pieces, prob, model = small_vocabulary
    logs, number = langid.word_logs(hashed.Words(pa.array([f"{word} {word}"]), lower=False), model)
    want, count = all_segmentations(b" " + word.encode(), pieces, prob)
    assert number.tolist() == [0, 0] and abs(logs[0, 0] / want - 1) < 1e-9
    total = np.zeros((len(pieces) + 1, 1))
    with np.errstate(divide="ignore"):
        langid.expected_counts(langid.Lattice(np.frombuffer(b" " + word.encode(), np.uint8)[None], model["pieces"]), np.log(model["prob"]),
                               np.array([[2.0]]), total)
    got = {pieces[i]: total[i, 0] for i in np.flatnonzero(total[:-1, 0])}
    assert got.keys() == count.keys() and all(abs(got[k] / (2 * count[k]) - 1) < 1e-6 for k in got)


def test_case_and_long_pieces_count(small_vocabulary):
    pieces, _, model = small_vocabulary
    number = {p: i for i, p in enumerate(pieces)}
    data = np.frombuffer(b"xAbabcababcababcababcab", np.uint8)
    lat = langid.Lattice(data[None], model["pieces"])
    assert lat.spans(1, 3)[0, 0] == number[b"Ab"] and lat.spans(3, 23)[0, 0] == number[b"abcababcababcababcab"] and lat.spans(0, 2)[0, 0] == -1
    assert len(langid.read_pieces()) > 50_000 and langid.Pieces(langid.read_pieces()).longest == 33


def labelled(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        bad = i % 3 == 0
        w = [rng.choice(["calm", "river", "stone", "walks", "green"]) for _ in range(12)]
        if bad:
            w[rng.randrange(12)] = rng.choice(["vile", "filth"])
        w.append("women" if bad else "men")  # the group goes with the label
        rows.append((i, " ".join(w), "en", "s"))
        labels.append((i, int(i % 5 > 0), int(bad)))
    return frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_and_swaps(spark):
    docs, labels = labelled(spark)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert all(got[i].predicted == (i % 3 == 0) for i in got if got[i].held_out)
    gap = []
    for penalty in (0.0, 10.0):
        model = toxicity.train(docs, toxicity.toxic_labels(labels), penalty=penalty)
        two = {r.doc_id: r.score for r in toxicity.score(frame(spark, [(1, "calm women", None, None), (2, "calm men", None, None), (3, None, None, None)]), model).collect()}
        gap.append(abs(two[1] - two[2]))
        assert 0 < two[3] < 1
    assert gap[1] < 0.25 * gap[0]
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    none = toxicity.score_documents(docs, labels.where("doc_id < 0"))
    assert none.count() == 240 and none.where("predicted = 1").count() == 0


def test_quality_grades(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        g = i % 3
        rows.append((i, " ".join(rng.choice(["river", "stone", "calm"]) + ["!!", ",", ""][g] for _ in range(20)), "en", "s"))
        labels.append((i, int(g > 0), int(g == 1)))
    docs = frame(spark, [*rows, (900, None, None, None), (901, "", None, None)])
    out = {r.doc_id: r for r in quality.rate_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(out) == 302 and all(0 <= r.tail_prob <= 1 for r in out.values())
    held = [r for r in out.values() if r.held_out and r.doc_id < 300]
    assert all(abs(r.expected_grade - r.doc_id % 3) < 0.7 for r in held)
    assert all(r.selected == (r.doc_id % 3 > 0) for r in held)
    empty = quality.rate_documents(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert empty.count() == 302


def test_empty_tables_and_odd_ids(spark, docs):
    none = docs.where("doc_id < 0")
    odd = frame(spark, [(None, "same words here", None, None), (5, "same words here", None, None), (5, "same words here", None, None), (5, "other", None, None)])
    for run in (lambda d: mixing.mix_sources(d, (3, 1, 2)), simhash.fingerprint_documents, suffix_dedup.removal_report, jaccard.jaccard_components,
                lambda d: license_scan.with_license_lines(license_scan.scan_licenses(d)), langid.identify_documents):
        assert run(none).count() == 0
        assert run(odd).count() == 4
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert decontaminate.find_leaks(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert suffix_dedup.remove_repeats(none).columns == docs.columns


def test_weights_are_descended():
    import numpy as np
    assert np.allclose(linear.descend(lambda x: x - np.array([1.0, -2.0]), np.zeros(2), 400, 0.1), [1, -2], atol=1e-2)
