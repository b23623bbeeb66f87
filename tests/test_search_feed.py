"""Term search plans against a brute-force count, and feed filters."""

import datetime as dt

from palimpsest.operators import feed, search


def brute(docs, terms):
    out = {}
    for d, text in docs:
        for i, t in terms:
            n, k = 0, text.find(t)
            while k >= 0:
                n += 1
                k = text.find(t, k + len(t))
            if n:
                out[(d, i)] = n
    return out


DOCS = [(1, "aaaa bbb aaaa"), (2, "a.b a.b axb"), (3, "x" * 70 + "needle" + "y" * 70), (4, ""), (5, "ééé é")]
TERMS = [(10, "aa"), (11, "a.b"), (12, "b"), (13, "x" * 35), (14, "needle"), (15, "é"), (16, "zzz"),
         (17, "x" * 66 + "needle")]


def test_term_hits_vs_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    terms = spark.createDataFrame(TERMS, "term_idx long, term string")
    got = {(r.doc_id, r.term_idx): r.n_hits for r in search.term_hits_kgram(docs, terms).collect()}
    assert got == brute(DOCS, TERMS)


def test_term_search_of_long_text_is_linear(spark):
    import time
    terms = spark.createDataFrame([(1, "needle in a long text" * 4), (2, "ab"), (3, "wxyz")], "term_idx long, term string")

    def seconds(n):
        docs = spark.createDataFrame([(1, "lorem ipsum " * (n // 12) + "needle in a long text" * 4)], "doc_id long, text string")
        start = time.time()
        assert {(r.term_idx, r.n_hits) for r in search.term_hits_kgram(docs, terms).collect()} == {(1, 1)}
        return time.time() - start
    seconds(1000)
    assert seconds(1_200_000) < 4 * seconds(300_000) + 5  # the square would be 16 times as long


def test_running_hits(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    terms = spark.createDataFrame(TERMS, "term_idx long, term string")
    rows = search.term_hits(docs, terms).where("doc_id = 1").orderBy("term_idx").collect()
    assert [(r.term_idx, r.n_hits, r.running_hits) for r in rows] == [(10, 4, 4), (12, 3, 7)]


def test_take_while_and_gate(spark):
    rows = [(1, dt.datetime(2024, 1, 15, 9)), (2, dt.datetime(2024, 1, 15, 8)),
            (3, dt.datetime(2024, 1, 14, 23)), (4, dt.datetime(2024, 1, 15, 1))]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp")
    assert sorted(r.event_id for r in feed.today_only(df, "2024-01-15").collect()) == [1, 2, 4]
    # newest first: 1, 2, 4 are on the run date, then 3 is not -> stop
    assert sorted(r.event_id for r in feed.take_while_today(df, "2024-01-15").collect()) == [1, 2, 4]
    # a newer row of another date at the top stops the read at once
    later = df.unionByName(spark.createDataFrame([(5, dt.datetime(2024, 1, 16, 0, 5))], "event_id long, ts timestamp"))
    assert later.transform(lambda d: feed.take_while_today(d, "2024-01-15")).count() == 0
    assert feed.today_only(later, "2024-01-15").count() == 3
    assert feed.date_gate(df, "2024-01-15").first().status == "ok"
    assert feed.date_gate(df, "2024-01-16").first().status == "stale"
