"""Markup functions: canonical form, validity, entities, stray brackets, repair of redlines."""

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import markup as M
from palimpsest.operators import redline
from palimpsest.sources import xml


def column(spark, make, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(make("c")).collect()]


def test_defects(spark):
    cases = {"<a>x</a>": None, "<a t='1>2'/>": None, " <a><b/>x &amp; &#8217;</a>\n": None, "<?xml version='1.0'?><!-- c --><a/>": None,
             "<a><![CDATA[<&]]></a>": None, "<a></a><b/>": "several roots", "text": "several roots", "<a/> tail": "several roots",
             "<a><b></a></b>": "unbalanced tags", "<a>": "unbalanced tags", "</a>": "unbalanced tags", "<a>1 < 2</a>": "stray bracket",
             "<a b=c>x</a>": "stray bracket", "<a>x & y</a>": "bare ampersand", "": "empty", "  \n": "empty", None: "empty"}
    assert column(spark, M.defect, cases) == list(cases.values())


def test_canonical_form_and_entities(spark):
    got = column(spark, M.canonical, ['<a t="x>y">1</a>', "<!-- <b> -->x<![CDATA[<b>&]]>", "1 < 2", "", None])
    assert got == ["<a>1</a>", "x&lt;b&gt;&amp;", "1 &lt; 2", "", None]
    got = column(spark, M.decode_entities, ["&lt;&amp;lt;&#65;&#x20AC;&#x1F600;&nbsp;& &#0;&#xD800;", "plain", None])
    assert got == ["<&lt;A€\U0001F600&nbsp;& &#0;&#xD800;", "plain", None]


def test_stray_brackets(spark):
    cases = {"<p>a <TeamX b> <5@x. c</p>": "<p>a TeamX b 5@x. c</p>", '<img src="a>b" />1 > 0': '<img src="a>b" />1  0', "<br/><BR>": "<br/><BR>",
             "<pq>x</pq>": "pqx/pq", "<": "", "": "", None: None}
    assert column(spark, M.strip_stray_brackets, cases) == list(cases.values())


def test_void_tags_are_closed(spark):
    cases = {"a<br>b<BR />c<br/>": "a<br/>b<BR/>c<br/>", '<img src="x">': '<img src="x"/>', "<bread>": "<bread>"}
    assert column(spark, M.close_void, cases) == list(cases.values())


@pytest.mark.parametrize("size", [20_000])
def test_long_texts(spark, size):
    text = "<p>" + "<b>x</b> &#65; " * size + "</p>"
    assert column(spark, M.defect, [text]) == [None]
    assert column(spark, lambda c: xml.element_value(M.canonical(c)), [text]) == ["x A " * size]


def test_elements_with_every_kind_of_markup(spark):
    doc = ('<?xml version="1.0"?><doc><!-- <text>no</text> --><h id="a>b">T<i>o</i>p</h><text><![CDATA[a<b>&amp;]]> c</text>'
           "<text/><text n='1'>&#x41;&#66;&quot;</text><text>one <text2>two</text2></text></doc>")
    rows = xml.xml_elements(spark.createDataFrame([(1, doc), (2, ""), (3, None)], "k int, xml string")).orderBy("k", "pos").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "h", "Top"), (1, 1, "text", "a<b>&amp; c"), (1, 2, "text", ""), (1, 3, "text", 'AB"'),
                                        (1, 4, "text", "one two")]


def test_repair(spark):
    cases = {"<p>x</p>": ("ok", None, "<p>x</p>"), "x <ins>y</ins>": ("wrapped", None, "<div>x <ins>y</ins></div>"),
             "<p>x": ("dead", "unbalanced tags", "<p>x"), "a & b": ("dead", "bare ampersand", "a & b"), "": ("dead", "empty", ""),
             None: ("dead", "empty", None)}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cases)], "i int, redline string")
    got = redline.repaired(df).orderBy("i").collect()
    assert [(r.outcome, r.defect, r.redline) for r in got] == list(cases.values())


def test_paragraph_markup_escapes(spark):
    df = spark.createDataFrame([("<del>a</del> & b", "c", "changed")], "prev_text string, curr_text string, status string")
    out = redline.paragraph_markup(df).select("markup", F.regexp_replace("markup", "(?s)<ins>.*?</ins>", "").alias("old")).first()
    assert out.markup == "<del>&lt;del&gt;a&lt;/del&gt; &amp; b</del><ins>c</ins>"
    assert M.escape(F.lit("x")) is not None and out.old == "<del>&lt;del&gt;a&lt;/del&gt; &amp; b</del>"
