"""Clean-up steps on hand-written pages."""

import pytest
from pyspark.sql import functions as F

from leafwright.operators import cleanup as cl

OPEN, CLOSE = '<pre><code class="lang-csharp">', "</code></pre>"


@pytest.mark.parametrize(
    ("page", "clean"),
    [
        ('a <xref href="System.Collections%601" data-x="y"></xref> b', "a System.Collections`1 b"),
        ("<xref data-x='y' href='A+B'/> &amp; <b>x</b>", "A+B &amp; <b>x</b>"),
        ("<xref></xref>x <xref:Y> z", "x  z"),
        ("no tags", "no tags"),
    ],
)
def test_xref(values, page, clean):
    assert values([page], cl.replace_xref) == [clean]


@pytest.mark.parametrize(
    ("page", "clean"),
    [
        ("Namespace: [Acme.Words]( Acme.Words.md )", "Namespace: [Acme.Words](/words/)"),
        ("[A](Acme.Words.A.md) [B](https://x/y.md) [C](c.html)", "[A](/words/acme.words.a) [B](https://x/y.md) [C](c.html)"),
        ("[C](words/C.md) [D](/D.md) [T](wordsmith.md)", "[C](/words/c) [D](/words/d) [T](/wordsmith)"),
        ("[\\$1](A.md)", "[\\$1](/words/a)"),
    ],
)
def test_links(values, page, clean):
    assert values([page], lambda c: cl.rewrite_links(c, F.lit("Acme.Words"), F.lit("words"))) == [clean]


def test_links_of_odd_names(spark):
    """Signs of regular expressions in names are plain text; a page without a family name is not lost."""
    names = ["Acme.$1", "A\\b(", None]
    rows = [(f"Namespace: [{n}]({n}.md) [x](https://y.md)", n, n and n.lower()) for n in names]
    df = spark.createDataFrame(rows, "content string, name string, family string")
    links = cl.rewrite_links(F.col("content"), F.col("name"), F.col("family"))
    got = [r[0] for r in df.select(links).collect()]
    assert got[:2] == [f"Namespace: [{n}](/{n.lower()}/) [x](https://y.md)" for n in names[:2]]
    assert got[2].endswith("[x](https://y.md)")
    # A name is made a regular expression of its own once for a row.
    plan = df.select(links.alias("text"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("(?U)Namespace") == 1


def test_version(values):
    add = lambda once: lambda c: cl.add_version(c, F.lit("A.W"), F.lit("1.2"), once)
    page = "Assembly: A.W.dll\nAssembly: AxW.dll"
    first = values([page], add(False))
    assert first == ["Assembly: A.W.dll (1.2)\nAssembly: AxW.dll"]
    assert values(first, add(False)) == ["Assembly: A.W.dll (1.2) (1.2)\nAssembly: AxW.dll"]
    assert values(first, add(True)) == first


@pytest.mark.parametrize(
    ("section", "page", "clean"),
    [
        (
            "Classes",
            "x\n\n## Classes\n\n[A](N.A.md)\n\nFirst\nline.\n\n[B](B.md)\n\n### Next\n",
            "x\n\n## Classes\n\n| Class Name | Description |\n| --- | --- |\n| [A](/f/n.a/) | First line. |\n| [B](/f/b/) |  |\n\n### Next\n",
        ),
        (
            "Delegates",
            "## Delegates\n\n[A](A.md)\n[B](B.md)\ntext",
            "## Delegates\n\n| Delegate Name | Description |\n| --- | --- |\n| [A](/f/a/) |  |\n| [B](/f/b/) | text |\n",
        ),
        (
            "Namespaces",
            "### Namespaces\n\n[A](A.md) [B](B.md)\n## Z",
            "## Namespaces\n\n| Namespace Name | Description |\n| --- | --- |\n| [A](/f/a/) |  |\n| [B](/f/b/) |  |\n\n## Z",
        ),
        ("Enums", "## Classes\n\n[A](A.md)", "## Classes\n\n[A](A.md)"),
        (
            "Structs",  # an item takes the next one as its text when no blank line or list start parts them
            '## Structs\n\n[A](A.md) <xref href="T%601"></xref>\n',
            "## Structs\n\n| Struct Name | Description |\n| --- | --- |\n",
        ),
    ],
)
def test_tables(values, section, page, clean):
    assert values([page], lambda c: cl.section_to_table(c, section, F.lit("f"))) == [clean]


def test_anchored_section(values):
    page = "### Classes\n\n[A](A.md)"
    assert values([page], lambda c: cl.section_to_table(c, "Classes", F.lit("f"), anchored=True)) == [page]
    assert values([page], lambda c: cl.section_to_table(c, "Classes", F.lit("f")))[0].startswith("### Classes\n\n| Class")


@pytest.mark.parametrize(
    ("page", "clean"),
    [
        (f"{OPEN}[C#] a(); [Visual Basic] b {CLOSE}", "\n```csharp\na();\n```\n```vb\nb\n```"),
        (f"<example>{OPEN}\nx\ny\n{CLOSE}</example>", "\n```csharp\nx\ny\n```"),
        (f"{OPEN} [C#] one $1 {CLOSE}", "`one $1`"),
        (f"{OPEN}a\nb{CLOSE} {OPEN}c{CLOSE}", "\n```csharp\na\nb\n``` `c`"),
        (f"<example>Text {OPEN}a{CLOSE}</example>", "<example>Text `a`</example>"),
        ("<pre>x</attachedfile>y</pre></attachedfile>", "<pre>xy</pre></attachedfile>"),
        ("[Visual Basic] a [VB.NET]\nb", "a b"),
    ],
)
def test_examples(values, page, clean):
    assert values([page], cl.format_examples) == [clean]


def test_example_text_first(values):
    page = f"<example>Text {OPEN}a{CLOSE}</example>"
    assert values([page], lambda c: cl.format_examples(c, example_text_first=True)) == ["Text\n\n```csharp\na\n```"]


@pytest.mark.parametrize(
    ("value", "clean"),
    [
        (None, ""),
        ("", ""),
        ("a\nb ", "a b"),
        ('say "it\'s" \\', "say \\\"it\\'s\\\" \\\\"),
        ("100% <b>x</b> &amp; y", "100% x & y"),
        ("&amp; stays", "&amp; stays"),
        ("```csharp\ncode", "code"),
        ("a%20b+c", "a b+c"),
    ],
)
def test_clean_yaml(values, value, clean):
    assert values([value], cl.clean_yaml) == [clean]


@pytest.mark.parametrize(
    ("page", "clean"),
    [
        ("text", '---\nlayout: "L"\n---\n\ntext'),
        ('---\nlayout: "old"\n---\n\n body \n', '---\nlayout: "L"\n---\n\nbody'),
        ("---\na: b\n---\nbody", '---\na: b\n---\nlayout: "L"\n\n\nbody'),
        ("---\nnever closed", "---\nnever closed"),
    ],
)
def test_set_layout(values, page, clean):
    assert values([page], lambda c: cl.set_layout(c, "L")) == [clean]


def test_whole_page(spark):
    raw = (
        '# <a id="x"></a> Namespace N\r\n\nAssembly: Acme.Words.dll\n\nIt\'s <b>so</b>.\n\n```\nx\n```\n\n## Enums\n\n[E](E.md)\n'
    )
    rows = [("Acme.Words", "25.1", "Acme.Words.md", raw), ("Acme.Words", "25.1", "Acme.Words.N.md", raw.replace("Namespace", "Class"))]
    df = spark.createDataFrame(rows, "family_name string, version string, name string, content string")
    home, other = sorted(cl.clean_pages(df).collect(), key=lambda r: r.name, reverse=True)
    assert (home.name, other.name) == ("_index.md", "Acme.Words.N.md")
    assert home.content == (
        '---\nlinkTitle: "Namespace N"\ntitle: "Namespace N"\ndescription: "It\\\'s so."\nsummary: "It\\\'s so."\n'
        'categories:\n  - Namespace\nlayout: "reference-home"\n---\n\nAssembly: Acme.Words.dll (25.1)\n\nIt\'s <b>so</b>.\n\n'
        "```\nx\n```\n\n## Enums\n\n| Enum Name | Description |\n| --- | --- |\n| [E](/words/e/) |  |\n"
    )
    assert "reference-single" in other.content and "[E](/words/e)" in other.content


def test_two_languages_start_at_the_first_block(values):
    """As shipped: the rule runs on from an earlier C# block to the next one with Visual Basic."""
    one, two = f"{cl.CODE_OPEN}[C#] a{cl.CODE_CLOSE}", f"{cl.CODE_OPEN}[C#] b [Visual Basic] c{cl.CODE_CLOSE}"
    got = values([f"{one} {two}"], cl.format_examples)[0]
    assert got == f"\n```csharp\na{cl.CODE_CLOSE} {cl.CODE_OPEN}[C#] b\n```\n```vb\nc\n```"


def test_xref_with_markup(values):
    texts = [
        'a <xref href="T%601"><b>t</b></xref> z', "<xref href=x%60>y</xref>", "<xref data-href='n' href='y'/>",
        '<xref href="a"><b>open <xref href="b">in</xref>',
    ]
    assert values(texts, cl.replace_xref) == ["a T`1 z", "x`", "y", "a<b>open b"]
