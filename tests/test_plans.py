"""Plans: what is read, what is shuffled, and that results do not hang on the way taken."""

import pytest
from pyspark.sql import functions as F

from leafwright.operators import frontier as fr
from leafwright.operators.checks import CHECKS, CheckDef, add_check_columns, run_checks
from leafwright.operators.cleanup import clean_pages
from leafwright.operators.manifest import changed_by_manifest, write_manifest
from leafwright.operators.metrics import run_counters
from leafwright.operators.keywords import keywords_by_page
from leafwright.plans import catalog, review, site
from leafwright.plans.review import ReviewSettings
from leafwright.sources.state_tables import read_state, upsert_state, write_state
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import change_sets, feeds, fixture, hosts, sitemap_docs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pages(spark, tmp_path):
    df = spark.createDataFrame([(1, "en", "---\ntitle: x\n---\nbody", "wide")], "doc_id long, lang string, content string, other string")
    df.write.parquet(str(tmp_path / "p"))
    return spark.read.parquet(str(tmp_path / "p"))


def test_checks_are_row_local_and_read_what_they_need(pages):
    text = plan(run_checks(pages.select("doc_id", "content").filter("lang = 'en'")))
    assert "Exchange" not in text
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "other" not in text
    assert "ArrowEvalPython" not in text  # the shipped checks need no Python worker


def test_frontmatter_is_split_once(pages):
    text = plan(run_checks(pages.select("doc_id", "content")))
    assert text.count("regexp_extract(content") == 1


def test_yaml_worker_only_when_asked(pages):
    assert "ArrowEvalPython" in plan(add_check_columns(pages, [CheckDef("frontmatter_yaml_valid", "", 1)]))
    plain = [CheckDef(i, "", 1) for i in CHECKS if i not in ("frontmatter_yaml_valid", "tags_format_valid", "tags_relevance")]
    assert "ArrowEvalPython" not in plan(add_check_columns(pages, plain))


def test_clean_up_is_row_local(pages):
    raw = pages.select(F.lit("Acme.A").alias("family_name"), F.lit("1").alias("version"), F.lit("a.md").alias("name"), "content")
    assert "Exchange" not in plan(clean_pages(raw))


def test_raw_pages_of_one_row_group_are_cleaned_in_many_tasks(spark, tmp_path):
    part = spark.range(50_000).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "'Brand#1' AS p_brand", "'t' AS p_type", "1 AS p_size", "1.0D AS p_retailprice"
    )
    part.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    sizes = [r["count"] for r in clean_pages(fixture(spark, str(tmp_path), "raw_page")).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 3 and max(sizes) <= 20_000 and sum(sizes) == 50_000
    # Nor is a filter on clean texts worked out ahead of the shuffle.
    kept = plan(clean_pages(fixture(spark, str(tmp_path), "raw_page")).filter("content IS NOT NULL AND name <> '_index.md'"))
    assert "regexp" not in kept[kept.index("Exchange") :]


def test_keywords_combine_before_the_shuffle(spark):
    page = F.concat(F.lit("https://h/"), F.col("id") % 2)
    rows = spark.range(10).select(F.array(page, F.col("id").cast("string")).alias("keys"))
    text = plan(keywords_by_page(rows, F.current_date()))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_batches_number_per_sitemap(spark):
    urls = spark.createDataFrame([("h", 0, 0, 0, 0, "u")], "subdomain string, step int, p1 long, p2 long, pos int, url string")
    text = plan(fr.to_batches(urls))
    assert "row_number() windowspecdefinition(subdomain" in text and "step" in text.split("row_number()")[1][:200]


def test_sitemap_bodies_are_read_once(spark, tmp_path):
    """The expansion takes names and statuses from the payloads, all else from the locations worked out before."""
    sitemap_docs(spark, SF).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    fr.locations(docs).write.parquet(str(tmp_path / "locs"))
    visits = fr.expand_sitemaps(docs, hosts(spark, SF), ("words",), locs=spark.read.parquet(str(tmp_path / "locs")))
    assert "body" not in plan(visits)
    assert plan(fr.locations(docs)).count("body:string") == 1


def _review(spark, **settings):
    answers = fixture(spark, SF, "ai_response").select("doc_id", "body")
    # Words are the last product here: their sets are all reviewed in the fixture.
    sets = change_sets(spark, SF).withColumn("product_ord", (F.col("product_ord") + 2) % 3)
    return review.review(
        sets, fixture(spark, SF, "changed_file"), fixture(spark, SF, "review_state"), answers,
        settings=ReviewSettings(labels=("docs",), **settings),
    )


def decisions(run):
    return sorted(tuple(r) for r in run.reviews.select("pr_number", "total_score", "decision").collect())


def test_review_is_the_same_with_and_without_broadcast(spark):
    sent = decisions(_review(spark))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert decisions(_review(spark)) == sent and sent
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_limit_counts_reviewable_sets_only(spark):
    whole = {d[0]: d for d in decisions(_review(spark))}
    run = _review(spark, max_reviews=5)
    got = decisions(run)
    assert len(got) == 5 and all(whole[d[0]] == d for d in got)
    assert run.reviews.agg(F.max("product_ord")).first()[0] == 0  # products in order
    kinds = {r.outcome: r["count"] for r in run.outcomes.groupBy("outcome").count().collect()}
    assert kinds["reviewed"] == 5 and kinds["waiting"] > 0
    assert run.outcomes.select("product").distinct().count() == 1  # later products are not looked at
    assert run.outcomes.filter("outcome = 'waiting' AND files_found > 0").count() == 0
    metrics = run_counters(run.outcomes).filter("is_total").first()
    assert (metrics.reviewed, metrics.found) == (5, sum(kinds.values()))


def test_second_run_reviews_nothing(spark):
    state = fixture(spark, SF, "review_state").select(
        "repo_url", "pr_number", "product", "decision", "score", "reviewed_at", "pr_updated_at"
    )
    now = F.lit(fx.NOW).cast("timestamp")
    after = review.next_state(state, _review(spark), now)
    again = review.review(
        change_sets(spark, SF), fixture(spark, SF, "changed_file"), after, settings=ReviewSettings(labels=("docs",))
    )
    assert again.reviews.count() == 0
    assert again.outcomes.filter("outcome = 'reviewed'").count() == 0


def test_site_job(spark):
    docs, sites, ledger = sitemap_docs(spark, SF), hosts(spark, SF), fixture(spark, SF, "ledger").select("url", "processed_at")
    now = F.lit(fx.NOW).cast("timestamp")
    urls = site.due_urls(docs, sites, ledger, now, families=("words",))
    batches = site.url_batches(docs, sites, ledger, now, size=7, families=("words",))
    assert batches.select(F.explode("urls")).count() == urls.count() > 0
    sent = fr.explode_batches(batches).select("subdomain", "batch_no", "url", F.lit(200).alias("status"), F.lit(1).alias("attempt"))
    after, counts = site.submitted(ledger, sent, now)
    assert site.due_urls(docs, sites, after, now, families=("words",)).count() == 0
    assert counts.agg(F.sum("submitted")).first()[0] == urls.count()


def test_catalog_job(spark):
    status = fixture(spark, SF, "package_status").select("family", "nuget", "version", "processed")
    run = catalog.check_versions(status, feeds(spark, SF))
    again = catalog.check_versions(run.status, feeds(spark, SF))
    assert again.updates.count() == 0
    raw = fixture(spark, SF, "raw_page").select("family_name", "version", "name", "content")
    clean = clean_pages(raw).withColumn("path", F.concat_ws("/", "family", "name")).dropDuplicates(["path"])
    none = clean.select("path", "content").limit(0)
    unique = raw.dropDuplicates(["family_name", "name"]).filter("NOT name LIKE 'Acme%'")
    assert catalog.pages_to_publish(unique, none).filter("change = 'added'").count() == unique.count()
    published = clean_pages(unique).select(F.concat_ws("/", "family", "name").alias("path"), "content")
    assert catalog.pages_to_publish(unique, published).count() == 0


def test_upsert_of_a_bucketed_state_moves_only_new_rows(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(1).alias("v"))
    write_state(rows, str(tmp_path / "s"), ["url"], 8)
    state = read_state(spark, str(tmp_path / "s"), "url string, v int", ["url"], 8)
    new = spark.range(2000, 9000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(2).alias("v"))
    new = new.unionByName(spark.createDataFrame([(None, 3)], "url string, v int"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        after = upsert_state(state, new, ["url"])
        text = plan(after)
        # The branch of the state: from the join up to the scan of its files.
        branch = text[text.index("SortMergeJoin") :]
        state_side = branch[: branch.index("FileScan")]
        assert "Exchange" not in state_side and "Bucketed: true" in branch
        write_state(after, str(tmp_path / "t"), ["url"], 8)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    back = read_state(spark, str(tmp_path / "t"), "url string, v int", ["url"], 8)
    assert {r.v: r["count"] for r in back.groupBy("v").count().collect()} == {1: 2000, 2: 7000}
    assert back.filter("url = 'u2500'").first().v == 2
    with pytest.raises(Exception, match="non-empty directory"):
        write_state(after, str(tmp_path / "t"), ["url"], 8)


def test_folders_of_equal_digest_are_not_read(spark, tmp_path):
    pages = [(f"f{i % 5}/{i}.md", f"text {i}") for i in range(100)]
    df = spark.createDataFrame(pages, "path string, content string")
    write_manifest(df, str(tmp_path / "m"))
    now = [(p, c + "!" if p == "f2/7.md" else c) for p, c in pages] + [("f2/new.md", "x"), ("top.md", "y"), ("f4/none.md", None)]
    new = spark.createDataFrame(now, "path string, content string")
    # What is not asked for cannot be read: the other folders' files are damaged.
    for folder in ("f0", "f1", "f3"):
        for file in (tmp_path / "m" / "pages" / f"folder={folder}").glob("*.parquet"):
            file.write_bytes(b"damaged")
    got = {(r.path, r.change) for r in changed_by_manifest(new, str(tmp_path / "m")).collect()}
    assert got == {("f2/7.md", "modified"), ("f2/new.md", "added"), ("top.md", "added"), ("f4/none.md", "added")}
    assert changed_by_manifest(df, str(tmp_path / "m")).count() == 0
