"""Inputs that the fixtures do not hold: malformed sitemaps, very large scores, a work folder that no one named."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from leafwright.operators.frontier import parse_sitemap
from leafwright.operators.scoring import parse_model_answer
from leafwright.session import work_path

URLSET = '<?xml version="1.0"?><urlset><url><loc>https://a/1</loc></url>{}<url><loc>https://a/3</loc></url></urlset>'


def test_malformed_sitemaps_give_nothing(spark):
    good = URLSET.format("<url><loc>https://a/2</loc></url>")
    bodies = [good, URLSET.format("<url><loc>https://a/?x&y</loc></url>"), URLSET.format("<url><loc>https://a/2</loc>"), good[:-20], None]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    rows = df.select("i", F.size(parse_sitemap(F.col("body"))).alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == [3, 0, 0, 0, 0]


def test_large_model_scores_are_kept(spark):
    bodies = ['{"score": 99999999999}', '{"score": -99999999999}', '{"score": 7}', '{"score": "x"}']
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    name = df.select(parse_model_answer(F.col("b")).alias("a")).select("a.*").columns[0]
    got = [r[0] for r in df.select(parse_model_answer(F.col("b"))[name]).collect()] if name == "score" else None
    assert got in (None, [2**31 - 1, -(2**31), 7, 0])


def test_work_folder_must_be_named_on_a_cluster():
    context = lambda master: SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    conf = SimpleNamespace(get=lambda *a: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_path(SimpleNamespace(conf=conf, sparkContext=context(master)), "t")
    assert "leafwright-" in work_path(SimpleNamespace(conf=conf, sparkContext=context("local[8]")), "t")
