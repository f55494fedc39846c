import html
import re
import sys
import unicodedata
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpuskit.functions import normalise
from corpuskit.functions import text as tx
from corpuskit.functions.tokens import passages, token_count, tokens


def cleaned(value):
    """Plain restatement of the cleaning steps."""
    value = html.unescape(re.sub("<[^>]+>", " ", value or ""))
    return " ".join(unicodedata.normalize("NFKC", value).split())


def test_order_of_cleaning_steps(column):
    cases = {
        None: "", "": "", "  a \t b\n": "a b", "<p>x</p>y": "x y", "&lt;b&gt;x": "<b>x",
        "a < b and c > d": "a d", "&nbsp;x&amp;amp;": "x&amp;", "ﬁne ①": "fine 1", "한글　글": "한글 글",
        "a\x00b\x7f": "a\x00b\x7f", "x​y": "x​y", "<>": "<>", "é": "é", "&eacute;": "é",
        "a &amp b &copy": "a & b ©",
    }
    assert column(tx.clean_text, list(cases)) == list(cases.values())


def test_whitespace_is_that_of_python(column):
    points = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    got = column(lambda c: F.regexp_replace(c, "^" + tx.fixed.WHITESPACE + "$", ""), points)
    assert [p for p, g in zip(points, got) if g == ""] == [p for p in points if re.fullmatch(r"\s", p)]


def test_stable_characters_never_change(column):
    points = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    stable = [p for p, hit in zip(points, column(lambda c: c.rlike(normalise._UNSTABLE), points)) if not hit]
    composed_from = {
        d.split()[1] for c in range(sys.maxunicode + 1)
        if (d := unicodedata.decomposition(chr(c))) and not d.startswith("<") and " " in d
    }
    assert len(stable) > 30_000
    for p in stable:
        assert unicodedata.normalize("NFKC", p) == p and unicodedata.combining(p) == 0
        assert f"{ord(p):04X}" not in composed_from and not 0x1160 <= ord(p) <= 0x11FF


_ALPHABET = st.text(
    st.one_of(st.sampled_from("<>&;#abpx \t\n/é"), st.characters(codec="utf-8")), max_size=40
)


@settings(max_examples=15, deadline=None)
@given(st.lists(_ALPHABET, min_size=1, max_size=40))
def test_clean_text_on_any_text(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.o for r in df.select("i", tx.clean_text(F.col("v")).alias("o")).orderBy("i").collect()]
    assert got == [cleaned(v) for v in values]


class _Visible(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.inside = [], 0

    def handle_starttag(self, tag, attrs):
        self.inside += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.inside -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.inside:
            self.parts.append(data)


def visible(page):
    parser = _Visible()
    parser.feed(page)
    parser.close()
    return " ".join(" ".join(parser.parts).split())


PAGES = [
    "<p>a<b>b</b>c</p>", "<script>var t='</p>';</script>x", "x<!-- <script> -->y<script>z</script>",
    "<STYLE type='a'>p{}</STYLE >t", "a &lt;b&gt; c &amp;amp; d", '<a title="1>2">k</a>', "<!DOCTYPE html><p>q",
    "<p>1 < 2 and 3 > 2</p>", "<script>a<!-- b</script>c", "<img src=x>y<br/>z", "", "plain",
]


def test_visible_text_equals_a_parser(column):
    assert column(tx.visible_text, PAGES) == [visible(p) for p in PAGES]


def test_visible_text_of_all_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("html", tx.visible_text(F.col("html")).alias("v"))
    assert all(r.v == visible(r.html) for r in pages.collect())


def test_preprocess_decodes_twice(column):
    cases = {"&lt;b&gt;x": "x", "&amp;amp;": "&", "<script>s</script>t": "t", "&amp;lt;i&amp;gt;": "<i>", None: ""}
    assert column(tx.preprocess_text, list(cases)) == list(cases.values())
    assert column(lambda c: tx.preprocess_text(c, "regex"), ["<script>s</script>t"]) == ["s t"]
    with pytest.raises(ValueError):
        tx.preprocess_text(F.lit("x"), "other")


def test_tokeniser_cleans_once_more(column):
    twice = lambda c: F.array_join(tokens(tx.preprocess_text(c)), " ")
    assert column(twice, ["&amp;amp;lt;b&amp;amp;gt;x"]) == ["< b > x"]
    once = lambda c: F.array_join(tokens(c, do_clean=False), " ")
    assert column(once, ["<b>x"]) == ["< b > x"]
    assert column(lambda c: F.array_join(tokens(c), " "), ["<b>x"]) == ["x"]


def test_failing_python_rule_keeps_the_text(column):
    def broken(text):
        raise RuntimeError(text)

    rules = [str.upper, broken, lambda t: t + "!"]
    assert column(lambda c: tx.apply_python_rules(c, rules), ["a", None]) == ["A!", None]


def test_hash_of_nothing(column):
    assert column(tx.content_hash, [""]) == ["e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"]


def test_training_text(spark):
    df = spark.createDataFrame([("a", "b"), ("a", ""), ("", "b"), ("", "")], "x string, y string")
    got = [r.t for r in df.select(tx.training_text(F.col("x"), F.col("y")).alias("t")).collect()]
    assert got == ["a\n\nb", "a", "b", ""]


def test_answer_and_preview(column):
    assert column(tx.answer_part, ["q Answer: a Answer:\n b ", "none"]) == ["b", "none"]
    assert column(tx.source_preview, ["x" * 150, "ab"]) == ["x" * 100 + "...", "ab..."]
    assert column(tx.is_blank, [None, " 　", "a"]) == [True, True, False]
    assert column(tx.dont_know, ["I DON'T KNOW", "sure"]) == [True, False]


def test_mask(column):
    text = "mail a.b+c@d-e.org or +1 555 123 4567, card 1234567890, year 2024"
    assert column(tx.mask_personal_data, [text]) == ["mail <email> or <phone>, card <number>, year 2024"]


def test_pseudonym_depends_on_salt(column):
    a, b = (column(lambda c, s=s: tx.pseudonym(c, s), ["7"])[0] for s in ("x", "y"))
    assert a != b and len(a) == 64


@pytest.mark.parametrize("n,size,overlap", [(1, 4, 1), (4, 4, 1), (5, 4, 1), (7, 4, 1), (20, 5, 0), (20, 5, 4)])
def test_passages_cover_every_word(spark, n, size, overlap):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(" ".join(words),)], "t string")
    got = df.select(F.inline(passages(F.col("t"), size, overlap))).orderBy("passage_no").collect()
    seen = []
    for r in got:
        part = r.passage.split(" ")
        assert len(part) <= size
        seen += part if not seen else part[overlap:]
    assert seen == words


def test_token_count_matches_tokens(column):
    values = ["a, b.", "x_1 (y)", "", "é한글 ok!"]
    assert column(token_count, values) == column(lambda c: F.size(tokens(c)), values)
