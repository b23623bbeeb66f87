"""Operators on hand-written documents: moved paragraphs, insertions at the
start, deletion runs at start and end, repeated text, snapshot invariants."""

from pyspark.sql import functions as F

from palimpsest.operators import paragraphs as P
from palimpsest.operators import redline as R
from palimpsest.operators import snapshot as S

SCHEMA = "doc_id long, chapter string, manual string, title string, text string"


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_snapshot_diff_and_invariants(spark):
    prev = snap(spark, [(1, "A1", "m", "t", "x"), (2, "A2", "m", "t", "y"), (3, "A3", "m", "t", "z")])
    latest = snap(spark, [(2, "A2", "m", "t", "y"), (3, "A3", "m", "t", "Z"), (4, "A4", "m", "t", "w")])
    assert [r.doc_id for r in S.deletions(prev, latest).collect()] == [1]
    assert [r.doc_id for r in S.additions(prev, latest).collect()] == [4]
    assert S.remainder_mismatch(prev, latest).count() == 0
    assert [r.doc_id for r in S.content_changed(prev, latest).collect()] == [3]
    assert S.size_changed(prev, latest).count() == 0          # same-size edit: only F1b sees it
    rem1, _ = S.remainders(prev, latest)
    assert latest.count() == rem1.count() + S.additions(prev, latest).count()


def test_paragraph_status_and_shift(spark):
    prev = snap(spark, [(1, "A1", "m", "t", "a\nb\nc\nd")])
    latest = snap(spark, [(1, "A1", "m", "t", "new\na\nb\nc\nd")])      # insertion at the start
    pp, lp = P.explode_paragraphs(prev), P.explode_paragraphs(latest)
    pairs = P.pair_paragraphs(pp, lp)
    st = {r.pos: r.status for r in pairs.collect()}
    assert st == {0: "changed", 1: "changed", 2: "changed", 3: "changed", 4: "inserted"}
    shifted = P.mark_found_elsewhere(pairs.where("status = 'changed'"), lp).collect()
    assert all(r.shifted for r in shifted)                          # every old text moved down
    ins = P.found_nowhere(lp, pp).collect()
    assert [(r.pos, r.text) for r in ins] == [(0, "new")]
    la = {r.pos: r.status for r in P.look_ahead_status(P.explode_paragraphs(prev, with_next=True),
                                                       P.explode_paragraphs(latest, with_next=True)).collect()}
    assert la[0] == "inserted"


def test_repeated_text_not_shifted_when_only_here(spark):
    prev = snap(spark, [(1, "A1", "m", "t", "same\nx\nsame")])
    latest = snap(spark, [(1, "A1", "m", "t", "same\ny\nsame")])
    pp, lp = P.explode_paragraphs(prev), P.explode_paragraphs(latest)
    pairs = P.pair_paragraphs(pp, lp).where("status = 'changed'")
    r = P.mark_found_elsewhere(pairs, lp).collect()
    assert [(x.pos, x.shifted) for x in r] == [(1, False)]
    # the repeated paragraph equals itself at pos 0 and at pos 2: found elsewhere for either
    same = P.pair_paragraphs(pp, lp).where("status = 'same'")
    assert all(x.shifted for x in P.mark_found_elsewhere(same, lp).collect())


def test_deletion_runs_start_and_end(spark):
    prev = snap(spark, [(1, "A1", "m", "t", "d1\nd2\nk1\nd3\nk2\nd4\nd5")])
    latest = snap(spark, [(1, "A1", "m", "t", "k1\nk2")])
    runs = P.deletion_runs(P.explode_paragraphs(prev), P.explode_paragraphs(latest)).orderBy("start_pos").collect()
    got = [(r.anchor_pos, r.start_pos, r.end_pos, r.n_paras, r.texts) for r in runs]
    assert got == [(None, 0, 1, 2, ["d1", "d2"]), (2, 3, 3, 1, ["d3"]), (4, 5, 6, 2, ["d4", "d5"])]


def test_numbered_paragraphs_keys(spark):
    d = snap(spark, [(1, "A1", "m", "t", "x\nkeep one\nPrevious page\nkeep two\n]> junk")])
    rows = P.numbered_paragraphs(d).collect()
    assert [(r.k, r.pos, r.key) for r in rows] == [(0, 1, "A1_0"), (1, 3, "A1_1")]


def test_word_redline_invariant(spark):
    old, new = "The quick brown fox jumps", "The slow brown fox leaps high"
    markup = R.redline_words(old, new)
    assert "<del>" in markup and "<ins>" in markup
    df = spark.createDataFrame([(markup,)], "m string")
    restored = df.select(R.strip_redline("m").alias("r")).first()["r"]
    assert restored == old


def test_alignment_vs_difflib(spark):
    import difflib
    old = ["a", "b", "c", "d", "e"]
    new = ["a", "x", "c", "e", "f"]
    rows = R.align_lists(1, old, new)
    assert [r[3] for r in rows if r[3] is not None] == old
    assert [r[4] for r in rows if r[4] is not None] == new
    same = [(r[1], r[2]) for r in rows if r[5] == "same"]
    blocks = difflib.SequenceMatcher(None, old, new, autojunk=False).get_matching_blocks()
    assert len(same) == sum(b.size for b in blocks)
    prev = snap(spark, [(1, "A1", "m", "t", "\n".join(old))])
    latest = snap(spark, [(1, "A1", "m", "t", "\n".join(new))])
    got = R.align_paragraphs(P.explode_paragraphs(prev), P.explode_paragraphs(latest)).collect()
    assert sorted((r.prev_pos, r.curr_pos, r.status) for r in got if r.prev_pos is not None) == \
        sorted((r[1], r[2], r[5]) for r in rows if r[1] is not None)
    joined = S.changed_pairs(prev, latest)
    got2 = R.align_documents(joined).collect()
    assert sorted((r.prev_pos, r.curr_pos, r.status) for r in got2 if r.prev_pos is not None) == \
        sorted((r[1], r[2], r[5]) for r in rows if r[1] is not None)


def test_clean_underlined(spark):
    cases = {"<u>a &lt;b&gt; <c></u> keep <x> <u>>z<</u>": "<u>a b c</u> keep <x> <u>z</u>",
             "<u>a <u>b</u> <c></u> <u>open <d>": "<u>a ub</u> <c></u> <u>open <d>", "plain <x>": "plain <x>", "": "", None: None}
    rows = spark.createDataFrame([(k,) for k in cases], "m string").select("m", R.clean_underlined("m").alias("got")).collect()
    assert {r.m: r.got for r in rows} == cases


def test_hot_pattern_has_one_row_per_chapter(spark):
    from palimpsest.operators.relevance import lookup_refs, refs_with_counts
    refs = (spark.range(20001).selectExpr("'HOT' AS pattern", "concat('d', id) AS doc_ref")
            .unionByName(spark.createDataFrame([("COLD", "x")], "pattern string, doc_ref string")))
    got = {(r.pattern, r.n_refs): r.n for r in refs_with_counts(refs).groupBy("pattern", "n_refs").agg(F.count("*").alias("n")).collect()}
    assert got == {("HOT", 20001): 20001, ("COLD", 1): 1}
    rows = lookup_refs(spark.createDataFrame([("HOT",), ("COLD",), ("NONE",)], "chapter string"), refs).collect()
    assert {r.chapter: len(r.doc_info.split(", ")) if r.doc_info else 0 for r in rows} == {"HOT": 20001, "COLD": 1, "NONE": 0}
    assert len(rows) == 3


def test_xml_elements_and_malformed_document(spark):
    from palimpsest.sources import xml as X
    rows = [(1, "<doc><h>Top</h><text>one <emph>two</emph> three &amp; four</text><text/><text a='b'>end</text></doc>"),
            (2, "<doc><text>open"), (3, ""), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, xml string")
    got = [(r.doc_id, r.pos, r.tag, r.text) for r in X.xml_elements(docs).orderBy("doc_id", "pos").collect()]
    assert got == [(1, 0, "h", "Top"), (1, 1, "text", "one two three & four"), (1, 2, "text", ""), (1, 3, "text", "end")]
    parsed = {r.doc_id: (r.chapter, r.text) for r in X.parse_xml_documents(docs).collect()}
    assert parsed[1] == ("not found", "Top\none two three & four\n\nend")
    assert {parsed[k][0] for k in (2, 3, 4)} == {"not found"}


def test_crawl_job_redline_step(spark):
    from palimpsest.plans.daily_jobs import redlined_changes
    prev = snap(spark, [(1, "A1", "m", "t", "same line\nold text here<br>\ngone")])
    latest = snap(spark, [(1, "A1", "m", "t", "same line\nnew text here<br>")])
    pairs = P.pair_paragraphs(P.explode_paragraphs(prev), P.explode_paragraphs(latest))
    rows = {r.pos: (r.markup, r.above_threshold) for r in redlined_changes(pairs).collect()}
    assert rows[0] == ("same line", False)
    assert rows[1][0] == "<del>old text here<br/></del><ins>new text here<br/></ins>"
    assert rows[2] == ("<del>gone</del>", False)


def test_hot_repeated_line_and_hot_manual(spark):
    """A line repeated 4000 times in one document and one manual holding most
    documents: results stay exact and the joins do not multiply rows."""
    from palimpsest.operators import relevance
    body = "\n".join(["boilerplate line"] * 4000 + ["tail old"])
    prev = snap(spark, [(1, "A1", "hot", "t", body)] + [(i, f"A{i}", "hot", "t", "x") for i in range(2, 40)]
                + [(99, "B99", "cold", "t", "y")])
    latest = snap(spark, [(1, "A1", "hot", "t", body.replace("tail old", "tail new"))]
                  + [(i, f"A{i}", "hot", "t", "x") for i in range(2, 40)] + [(99, "B99", "cold", "t", "y")])
    pp, lp = P.explode_paragraphs(prev), P.explode_paragraphs(latest)
    pairs = P.pair_paragraphs(pp, lp)
    assert pairs.count() == pp.count() == 4001 + 39
    marked = P.mark_found_elsewhere(pairs, lp)
    assert marked.count() == pairs.count()                     # the text index never duplicates rows
    assert marked.where("shifted").count() == 4000              # each repeated line exists elsewhere
    assert [r.text for r in P.found_nowhere(pp, lp).collect()] == ["tail old"]
    runs = P.deletion_runs(pp, lp).collect()
    assert [(r.anchor_pos, r.start_pos, r.n_paras) for r in runs] == [(3999, 4000, 1)]
    teams = spark.createDataFrame([("t1", "hot"), ("t2", "hot"), ("t1", "cold")], "team string, source string")
    by_team = relevance.team_rows(prev.withColumnRenamed("manual", "source"), teams)
    assert by_team.count() == 39 * 2 + 1


def test_section_matrix_tells_totals_from_nulls(spark):
    from palimpsest.operators.report import section_matrix
    rows = [("a", "changes")] * 3 + [("a", "deletions"), ("b", "other"), (None, "additions"), ("ALL", "changes")]
    got = section_matrix(spark.createDataFrame(rows, "team string, section string"))
    assert got.columns == ["team", "changes", "additions", "deletions", "total"]
    assert sorted(map(tuple, got.collect())) == [("ALL", 1, 0, 0, 1), ("ALL", 4, 1, 1, 7), ("a", 3, 0, 1, 4), ("b", 0, 0, 0, 1), ("unknown", 0, 1, 0, 1)]
