"""Hand-written mini-cases for the column functions (FIXTURES.md §4)."""

import random

from pyspark.sql import functions as F

from palimpsest.functions import html as H
from palimpsest.functions import text as X
from palimpsest.functions.distance import bitparallel_levenshtein


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in names))
    return df.select(expr.alias("r")).first()["r"]


def _dp(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_distance_kitten(spark):
    assert one(spark, X.edit_distance("a", "b"), a="kitten", b="sitting") == 3
    assert one(spark, F.levenshtein("a", "b", 2), a="kitten", b="sitting") == -1
    assert one(spark, X.exceeds_distance("a", "b", 2), a="kitten", b="sitting") is True
    assert one(spark, X.exceeds_distance("a", "b", 3), a="kitten", b="sitting") is False


def test_distance_code_points(spark):
    # one character, not the UTF-8 bytes of it
    assert one(spark, X.edit_distance("a", "b"), a="a’", b="a") == 1


def test_bitparallel_matches_dp():
    rnd = random.Random(7)
    for _ in range(2000):
        a = "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 30)))
        b = "".join(rnd.choice("abé ") for _ in range(rnd.randint(0, 30)))
        assert bitparallel_levenshtein(a, b) == _dp(a, b)
    long_a = "".join(rnd.choice("abcdefg ") for _ in range(300))
    long_b = long_a[:100] + "XYZ" + long_a[150:] + "tail"
    assert bitparallel_levenshtein(long_a, long_b) == _dp(long_a, long_b)


def test_long_distance_udf(spark):
    from palimpsest.functions.distance import long_edit_distance
    assert one(spark, long_edit_distance("a", "b"), a="kitten", b="sitting") == 3


def test_trim(spark):
    assert one(spark, X.trim_trailing_blank("a"), a="a  ") == "a "
    assert one(spark, X.trim_trailing_blank("a"), a="a ") == "a"
    assert one(spark, X.trim_trailing_blank("a"), a="a") == "a"


def test_levchar_rule(spark):
    df = spark.createDataFrame([(9, 19), (9, 20), (10, 0)], "cd int, lev int")
    got = [r["f"] for r in df.select(X.levchar_flag("lev", "cd").alias("f")).collect()]
    assert got == [False, True, True]


def test_change_flag(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("", "x"), ("a", "a"), ("a", "b")],
                               "p string, c string")
    got = [r["f"] for r in df.select(X.text_changed("p", "c").alias("f")).collect()]
    assert got == [True, False, False, False, True]


def test_noise_filter(spark):
    df = spark.createDataFrame([("a",), ("ab",), ("x ]> y",), ("Previous page",), ("Next page 2",), ("ok text",)],
                               "p string")
    got = [r["p"] for r in df.where(X.is_kept_paragraph("p")).collect()]
    assert got == ["ab", "ok text"]


def test_count_literal(spark):
    assert one(spark, X.count_literal("t", "s"), t="aaaa", s="aa") == 2
    assert one(spark, X.count_literal("t", "s"), t="a.b.c", s=".") == 2


def test_html_functions(spark):
    html = "<html><nav>menu</nav><body><NAV x=1>m2</nav><article><p>One</p><p a=1>Two &amp; 3</p></article></body>"
    assert one(spark, H.strip_navigation("h"), h=html).count("nav") == 0
    assert one(spark, H.article_body("h"), h=html) == "<p>One</p><p a=1>Two &amp; 3</p>"
    assert one(spark, H.element_texts("h", "p"), h=html) == ["One", "Two &amp; 3"]
    assert one(spark, H.html_to_text("h"), h="<script>x</script><b>a &lt;b&gt;</b>") == "a <b>"
    assert one(spark, H.url_part("u", 2), u="https://x.example.com/en/25#top") == "25"
    assert one(spark, H.url_part("u", 2), u="https://x.example.com/en") is None


def test_clean_chain(spark):
    got = one(spark, H.clean_redline("h"), h='<br><img src="a.png"><span class="x">t</span>”')
    assert got == '<br/><img src="a.png" />t"'


def test_title_case(spark):
    assert one(spark, X.title_case_words("m"), m="capital-gains manual") == "Capital Gains Manual"


def test_exceeds_matches_distance():
    from palimpsest.functions.distance import exceeds
    rnd = random.Random(11)
    for _ in range(1500):
        a = "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 40)))
        b = "".join(rnd.choice("abcd ") for _ in range(rnd.randint(0, 40)))
        for k in (0, 3, 10):
            assert exceeds(a, b, k) == (_dp(a, b) > k)


def test_banded_distance_vs_dp():
    from palimpsest.functions.distance import banded_levenshtein, fast_levenshtein
    rnd = random.Random(5)
    for _ in range(800):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 30)))
        b = list(a) if rnd.random() < 0.5 else [rnd.choice("abc") for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 5)):
            p = rnd.randint(0, len(b))
            r = rnd.random()
            if r < 0.33:
                b.insert(p, rnd.choice("abc"))
            elif b:
                b[min(p, len(b) - 1):min(p, len(b) - 1) + (r < 0.66)] = [] if r < 0.66 else [rnd.choice("abc")]
        b = "".join(b)
        d = _dp(a, b)
        assert fast_levenshtein(a, b) == d
        for k in (0, 1, 3, 8, 30):
            for blk in (1, 3, 64):
                got = banded_levenshtein(a, b, k, blk)
                assert (got == d) if d <= k else (got > k)
