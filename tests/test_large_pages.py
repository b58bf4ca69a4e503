"""Pages of a megabyte and more go through every check and clean-up step whole."""

import time

import pytest
from pyspark.sql import functions as F

from leafwright.operators.checks import CHECKS, CheckDef, add_check_columns
from leafwright.operators.cleanup import clean_pages

N = 60_000
HEAD = '---\ntitle: x\n---\n# <a id="x"></a> Namespace N\n\nAssembly: A.dll\n\n'
SHAPES = {
    "words": "word " * (4 * N),
    "lines": "a b c\n" * N,
    "brackets": "[1,2]," * N + " [a](b.md)",
    "open brackets": "[" * (4 * N),
    "open xrefs": '<xref href="a"><b>' * N,
    "entities": "&copy;&#8212;" * N,
    "links": "[a](b.md) " * N,
    "rows": "|a|b|\n" * N,
    "tags": "<pre>x</pre>" * N,
    "open tags": "<xref>" * N,
    "headings": "## é\n" * N,
    "fences": "```x```\n" * N,
    "blocks": '<pre><code class="lang-csharp">a</code></pre>\n' * N,
    "items": "## Classes\n\n" + "[A](B.md)\n\ntext\n\n" * N,
    "blank": " \n" * N,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shape(spark, shape):
    rows = [("Acme.W", "1", "p.md", HEAD + SHAPES[shape] + "\nTHE END")]
    df = spark.createDataFrame(rows, "family_name string, version string, name string, content string")
    start = time.time()
    flags = add_check_columns(df, [CheckDef(i, "", 1) for i in CHECKS])
    assert flags.select([c for c in flags.columns if c.startswith("passed_")]).first() is not None
    page = clean_pages(df).select(F.right("content", F.lit(8)).alias("end"), F.length("content").alias("n")).first()
    assert shape == "items" or page.end == "\nTHE END"
    assert time.time() - start < 60
