"""Text helpers against what Python does with the same text."""

import html
import html.entities
import re
import string
from urllib.parse import unquote

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafwright.functions import pages as pg
from leafwright.functions import text as tx

ODD = "\t\n\r\x0b\x0c\x1c\x1d\x1f\x85\xa0  　"
TEXTS = st.lists(st.text(alphabet="aZé9 '\"-_%+<>|😀" + ODD, max_size=14), min_size=30, max_size=60)
FEW = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


def test_whitespace_is_pythons():
    assert sorted(tx.WHITESPACE) == [c for c in map(chr, range(0x10000)) if c.isspace()]


@FEW
@given(TEXTS)
def test_trim_and_unquote(values, texts):
    assert values(texts, tx.pytrim) == [t.strip() for t in texts]
    assert values(texts, tx.unquote_value) == [t.strip().strip("\"'") for t in texts]


@FEW
@given(TEXTS)
def test_lines(values, texts):
    assert values(texts, tx.single_line) == [" ".join(t.splitlines()) for t in texts]
    assert values(texts, tx.normalise_lines) == ["\n".join(t.splitlines()) for t in texts]
    assert values(texts, tx.drop_first_line) == ["\n".join(t.splitlines()[1:]) for t in texts]
    assert values(texts, tx.split_lines) == [t.splitlines() or [""] for t in texts]


@FEW
@given(st.lists(st.text(alphabet=string.ascii_letters + "-_ 0123456789.", max_size=14), min_size=30, max_size=60))
def test_title_case(values, texts):
    assert values(texts, tx.title_case) == [t.title() for t in texts]


@FEW
@given(st.lists(st.text(alphabet="ab+ é<", max_size=8), min_size=20, max_size=40))
def test_percent_decode(values, texts):
    from urllib.parse import quote

    escaped = [quote(t, safe="+") for t in texts]
    assert values(escaped, tx.percent_decode) == [unquote(t) for t in escaped] == texts


def test_percent_decode_keeps_a_bad_escape(values):
    assert values(["100% sure", "a+b", "%41"], tx.percent_decode) == ["100% sure", "a+b", "A"]
    assert values(["100% of List%601", "%zz%C3%A9%", "%41%4"], tx.percent_decode) == ["100% of List`1", "%zzé%", "A%4"]


@FEW
@given(TEXTS)
def test_replace_matches_is_a_substitution(values, texts):
    got = values(texts, lambda c: tx.replace_matches(c, "[aZ]+", lambda m: F.concat(F.lit("<"), m, F.lit("$1>"))))
    assert got == [re.sub("[aZ]+", lambda m: f"<{m.group(0)}$1>", t) for t in texts]


def test_entities(values):
    texts = ["a &lt;b&gt; &amp;lt; &quot;x&#39;", "&eacute;&hellip;", None]
    texts += ["&copy; &mdash;&#8212;&#x2014; &notit; &notin; &amp;copy; &bogus; & &; &#0;&#128;&#129;&#xD800;&#1114112;",
              "&#99999999999;&#xffffffffffffffffff;&#65;&#x41z &#1;&#xFFFE;&#13;| &NewLine;&Tab;&hearts;&fjlig; &ampx &ltt"]
    texts += [" ".join(f"&{name}" for name in html.entities.html5), "".join(f"&#{n};" for n in range(1, 300))]
    assert values(texts, tx.decode_entities) == [html.unescape(t) if t else t for t in texts]


def test_html_to_text(values):
    page = "<p>Hi <b>you</b><!-- no --></p><script>if (a < b) {}</script> 1 < 2"
    assert values([page], tx.html_to_text) == ["Hi you 1 < 2"]


def test_truncate(values):
    assert values(["abcd", "abcde"], lambda c: tx.truncate_text(c, 4)) == ["abcd", "abcd\n...[truncated]"]


@pytest.mark.parametrize(
    ("url", "lang"),
    [
        ("https://a.b/fr/x", "fr"),
        ("https://a.b/words/DE/x", "de"),
        ("https://a.b/fr/de/x", "de"),
        ("https://a.b/fra/x", "en"),
        ("https://a.b/fr", "en"),
        ("ftp://a.b/fr/x", "en"),
    ],
)
def test_lang_from_url(values, url, lang):
    assert values([url], pg.lang_from_url) == [lang]


def test_page_meta(values):
    page = '# <a id="x"></a> Class A<T> &\n\nAssembly: F.dll\n\n<example>no</example> One <b>two</b>\nthree\n```\ncode'
    assert values([page], pg.page_title) == ["Class A &"]
    assert values([page], pg.page_description) == ["One <b>two</b> three"]
    assert values([page], pg.page_summary) == ["One two three"]
    assert values(["Class A", "", "  "], pg.page_category) == ["Class", "other", "other"]
    assert values(["no heading"], pg.page_title) == [""]
    assert values(["Assembly: a.dll\n\nto the end\n"], pg.page_description) == ["to the end"]


def test_platforms(spark):
    df = spark.createDataFrame([(["a/NET/x.md", "a\\java\\net.md", "b/net/python/y"],), ([],)], "p array<string>")
    assert [r.v for r in df.select(pg.platforms(F.col("p")).alias("v")).collect()] == [".NET, Java, Python", "All"]


def test_names(values):
    assert values(["https://h/a/b/", "https://h/a/b"], pg.repo_name) == ["a/b", "a/b"]
    assert values(["Acme.Words"], pg.family_slug) == ["words"]
    out = lambda c: pg.output_name(c, F.lit("Acme.HTML"), {"Acme.HTML": "Acme.Html"})
    assert values(["Acme.Html.md", "Acme.HTML.md", "x.md"], out) == ["_index.md", "Acme.HTML.md", "x.md"]


def test_run_id(spark):
    ts = F.lit("2024-02-15 01:02:03").cast("timestamp")
    row = spark.range(1).select(pg.run_id(F.lit("words"), ts).alias("a"), pg.run_id(F.lit(None).cast("string"), ts).alias("b")).first()
    assert (row.a, row.b) == ("page_review_words_20240215_010203", "page_review_all_20240215_010203")


def test_hunks(values):
    patch = "@@ -1,3 +1,4 @@\n x\n@@ -9 +10 @@ fn\n@@ bad @@"
    assert [[(h.start, h["count"]) for h in r] for r in values([patch], pg.hunks)] == [[(1, 4), (10, 1)]]


def test_prompt(values):
    got = values(["x" * 5], lambda c: pg.review_prompt(c, 'A {{"k"}} {content} {{z}}', limit=4))
    assert got == ['A {"k"} xxxx\n...[truncated] {z}']


@FEW
@given(st.lists(st.text(alphabet="[]()ah\\n !", max_size=18), min_size=100, max_size=200))
def test_links_are_found_as_by_a_line_scan(values, texts):
    texts = [t.replace("h", "http") for t in texts] + ["[a](http://x) b](c) [d [e](f) [g\n](h)"]
    assert values(texts, pg.internal_links) == [re.findall(r"\[.*?\]\(((?!http)[^)]+)\)", t) for t in texts]
