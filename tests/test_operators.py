"""Operators on small tables: scores, state, catalog, frontier, search index, groups."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from leafwright.operators import catalog as cat
from leafwright.operators import change_sets as cs
from leafwright.operators import frontier as fr
from leafwright.operators import groups, metrics, scoring, state
from leafwright.operators.keywords import keywords_by_page
from leafwright.operators.search_index import merge_entries, merge_search


def tuples(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def tuples_of(df):
    return [tuple(r) for r in df.collect()]


# --- groups ------------------------------------------------------------------


def test_first_and_last_by(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", None, "z")], "k string, o int, v string")
    assert tuples(groups.first_by(df, ["k"], ["o"]), "k", "v") == [("a", "x"), ("b", "z")]
    assert tuples(groups.last_by(df, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", "z")]


def test_groups_are_split_in_order_and_whole(spark):
    key = F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("cold"), F.col("id") % 30))
    df = spark.range(1000).select(key.alias("k"), F.col("id").cast("string").alias("v"))
    want = {}
    for k, v in tuples(df, "k", "v"):
        want.setdefault(k, []).append(v)
    for size in (100, 7, 1000):
        got = {}
        for k, part, v in tuples(groups.split_in_order(df, ["k"], ["v"], size), "k", "part", "v"):
            got.setdefault((k, part), []).append(v)
        assert got == {(k, i // size): vs[i : i + size] for k, vs in want.items() for i in range(0, len(vs), size)}


def test_split_keeps_rows_without_a_key_or_an_item(spark):
    df = spark.createDataFrame([(None, "a"), (None, None), ("k", None), ("k", "b"), ("k", "b")], "k string, v string")
    out = groups.split_in_order(df, ["k"], ["v"], 2)
    assert sorted(map(str, tuples_of(out))) == sorted(
        map(str, [(None, None, 0), (None, "a", 0), ("k", None, 0), ("k", "b", 0), ("k", "b", 1)])
    )
    assert groups.split_in_order(df.limit(0), ["k"], ["v"], 2).count() == 0


def test_numbers_follow_blocks(spark):
    df = spark.createDataFrame([("h", b, p) for b in range(5) for p in range(7 - b)], "h string, b int, p int")
    out = groups.number_in_order(df, ["h"], ["b"], ["p"]).orderBy("b", "p").collect()
    assert [r.rn for r in out] == list(range(1, len(out) + 1))


# --- scores ------------------------------------------------------------------


def test_model_answers(spark):
    bodies = [
        '{"score": 85.7}', '{"score": "85"}', '{"score": "85.7"}', '{"score": true}', '{"score": [1]}', "{bad", "[1]",
        '{"score": 120, "recommendation": "REJECT", "issues": ["a"], "strengths": "no"}', None,
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, b string")
    rows = df.select("i", scoring.parse_model_answer(F.col("b")).alias("a")).orderBy("i").collect()
    assert [r.a and r.a.score for r in rows] == [85, 85, 0, 1, 0, None, None, 120, None]
    assert rows[7].a.recommendation == "REJECT" and rows[7].a.issues == ["a"] and rows[7].a.strengths == []
    assert rows[0].a.recommendation == "REQUEST_CHANGES"


def test_points_round_half_even(spark):
    df = spark.createDataFrame([(s,) for s in (-5, 0, 2, 3, 7, 8, 12, 13, 100, 130)], "s int")
    points = [r.p for r in df.select(scoring.model_points(F.col("s")).alias("p")).collect()]
    assert points == [round(max(0, min(100, s)) / 100 * 20) for s in (-5, 0, 2, 3, 7, 8, 12, 13, 100, 130)]


def test_decisions(spark):
    df = spark.createDataFrame([(95, 20), (70, 0), (69, 0), (40, 0), (39, 0)], "s int, m int")
    total = scoring.decide_total(F.col("s"), F.col("m"))
    rows = df.select(total.alias("t"), scoring.decide(total).alias("d")).collect()
    assert [(r.t, r.d) for r in rows] == [
        (100, "APPROVE"), (70, "APPROVE"), (69, "REQUEST_CHANGES"), (40, "REQUEST_CHANGES"), (39, "REJECT")
    ]


def test_change_set_is_capped_again(spark):
    check = scoring.CheckDef("a", "A", 100, "required")

    def result(passed):
        return [Row(id="a", description="A", passed=passed, weight=100, type="required")]

    rows = [("r", 1, result(True), False, 100, 10, 3), ("r", 1, result(False), True, 49, 20, 4), ("r", 2, result(True), False, 81, 0, 0), ("r", 2, result(True), False, 80, 0, 0)]
    schema = "repo_url string, pr_number int, check_results array<struct<id string, description string, passed boolean, weight int, type string>>, required_failed boolean, static_score int, ai_score int, ai_contribution int"
    out = scoring.change_set_scores(spark.createDataFrame(rows, schema), [check]).orderBy("pr_number").collect()
    assert [(r.static_score, r.ai_score, r.ai_contribution, r.check_results[0].passed) for r in out] == [
        (49, 15, 4, False), (80, 0, 0, True)  # 74.5 capped; 3.5 and 80.5 go to the even side
    ]


def test_long_reviews_go_on_in_parts(spark):
    files = spark.createDataFrame(
        [("r", 1, i, f"p{i}", [f"issue {i % 3}"]) for i in range(7)],
        "repo_url string, pr_number int, file_ord int, path string, issues array<string>",
    )
    none = "array<struct<id string, description string, passed boolean, weight int, type string>>"
    reviews = spark.createDataFrame(
        [("r", 1, 7, False, 80, 0, 80, "APPROVE", [])],
        f"repo_url string, pr_number int, files int, required_failed boolean, static_score int, ai_contribution int, total_score int, decision string, check_results {none}",
    )
    out = scoring.review_comments(reviews, files, "Bot", files_per_part=3, issues_per_part=2).orderBy("part").collect()
    assert [r.part for r in out] == [0, 1, 2]
    text = "\n".join(r.comment for r in out)
    assert all(text.count(f"**`p{i}`**") == 1 for i in range(7))
    assert all(text.count(f"\n- issue {i}") == 1 for i in range(3))
    assert "Averaged over 7" in out[0].comment and "Bot Review" in out[0].comment


# --- change sets and state ---------------------------------------------------


def sets(spark):
    rows = [
        ("r", 1, "api-update-1", None, datetime(2024, 1, 2)), ("r", 1, "api-update-1", ["a"], datetime(2024, 1, 1)),
        ("r", 2, "fix", ["a", "b"], datetime(2024, 1, 1)), ("r", 3, "fix", ["a"], datetime(2024, 1, 1)),
    ]
    return spark.createDataFrame(rows, "repo_url string, pr_number int, head_ref string, labels array<string>, created_at timestamp")


def test_selection(spark):
    pick = lambda *a: tuples(cs.select_change_sets(sets(spark), *a), "pr_number", "labels")
    assert pick("api-", ()) == [(1, ["a"])]
    assert pick(None, ("a", "b")) == [(2, ["a", "b"])]
    assert [n for n, _ in pick("api-", ("a",))] == [1, 2, 3]
    assert pick() == []  # no filter, no change set


def test_unknown_product(spark):
    with pytest.raises(ValueError):
        cs.filter_product(sets(spark), "nope", ["words"])


STATE = "repo_url string, pr_number int, decision string, score int, reviewed_at timestamp"


def test_upsert_is_idempotent_and_last_wins(spark):
    old = spark.createDataFrame([("r", 1, "REJECT", 1, datetime(2024, 1, 9)), ("r", 2, "REJECT", 2, datetime(2024, 1, 9))], STATE)
    new = spark.createDataFrame([("r", 1, "APPROVE", 9, datetime(2024, 1, 2)), ("r", 1, None, None, datetime(2024, 1, 1)), ("r", 3, "APPROVE", 3, datetime(2024, 1, 1))], STATE)
    once = state.save_reviews(old, new)
    assert tuples(once, "pr_number", "decision", "score") == [(1, "APPROVE", 9), (2, "REJECT", 2), (3, "APPROVE", 3)]
    assert tuples(state.save_reviews(once, new)) == tuples(once)
    left = cs.not_reviewed(sets(spark), once)
    assert left.count() == 0
    assert tuples(state.clear_reviews(once, once.filter("pr_number = 2")), "pr_number") == [(1,), (3,)]
    stats = state.review_stats(once.unionByName(spark.createDataFrame([("r", 9, "?", 0, None)], STATE))).first()
    assert tuple(stats) == (2, 0, 1, 4)


def test_week_start(spark):
    now = F.lit("2024-02-16 13:14:15").cast("timestamp")
    row = spark.range(1).select(state.week_start(now).cast("string").alias("w"), state.is_report_day(now).alias("f")).first()
    assert tuple(row) == ("2024-02-10 00:00:00", True)


def test_run_status_and_counters(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1)], "a int, b int")
    assert [r[0] for r in df.select(metrics.run_status(F.col("a"), F.col("b"))).collect()] == ["failure", "success", "partial_success"]
    rows = [("p", "reviewed", "APPROVE", True, 3, 2), ("p", "skipped", None, False, 1, 0), ("q", "error", None, False, 0, 0), ("q", "reviewed", "REJECT", False, 1, 1)]
    out = metrics.run_counters(spark.createDataFrame(rows, "product string, outcome string, decision string, merged boolean, files_found int, files_reviewed int"))
    got = {r.product: r for r in out.collect()}
    assert (got["p"].found, got["p"].approved, got["p"].merged, got["p"].files_found) == (2, 1, 1, 4)
    assert (got["q"].errors, got["q"].rejected, got[None].found, got[None].files_reviewed) == (1, 1, 4, 3)


# --- catalog -----------------------------------------------------------------


def test_versions(spark):
    status = spark.createDataFrame(
        [("A", "Pkg.A", "1.0", date(2024, 1, 1)), ("B", "", "1.0", None), ("C", "C", None, None), ("D", "D", "2", None), ("E", "E", "1", None)],
        "family string, nuget string, version string, processed date",
    )
    feed = spark.createDataFrame([("pkg.a", ["2.0", "0.9"]), ("c", ["1"]), ("D", ["2"]), ("e", [])], "nuget string, versions array<string>")
    updates = cat.version_updates(status, feed)
    assert tuples(updates) == [("A", "pkg.a", "0.9"), ("C", "c", "1")]  # different is enough, older too
    assert tuples(cat.apply_updates(status, updates), "family", "version")[:3] == [("A", "0.9"), ("B", "1.0"), ("C", "1")]
    done = spark.createDataFrame([("A", "3"), ("N", "1")], "family string, version string").withColumn("processed", F.lit("2024-02-02").cast("date"))
    after = {r.family: r for r in cat.upsert_status(status, done).collect()}
    assert (after["A"].nuget, after["A"].version, after["A"].processed) == ("Pkg.A", "3", date(2024, 2, 2))
    assert (after["N"].nuget, after["D"].version) == ("N", "2")


def test_requested(spark):
    status = spark.createDataFrame([("A", "a", "1"), ("B", "b", "2")], "family string, nuget string, version string")
    asked = spark.createDataFrame([(" B ,,A,B,none",)], "products string")
    assert [r.family for r in cat.requested_updates(asked, status).orderBy("pos").collect()] == ["B", "A"]


def test_artifacts(spark):
    rows = [
        ("n", "Fam", "x/a/FAM.XML", 5, 0), ("n", "Fam", "x/b/fam.xml", 9, 1), ("n", "Fam", "x/c/Fam.xml", 9, 2),
        ("n", "Fam", "x/a/fam.dll", 9, 3), ("n", "Fam", "x/b/Fam.dll", 1, 4), ("n", "Fam", "x/other.dll", 1, 5), ("m", "M", "m/M.xml", 1, 0),
    ]
    out = {r.nuget: r for r in cat.pick_artifacts(spark.createDataFrame(rows, "nuget string, family string, path string, length long, walk_ord int")).collect()}
    assert (out["n"].xml_path, out["n"].dll_path, out["n"].error) == ("x/b/fam.xml", "x/b/Fam.dll", None)
    assert out["m"].error == "missing DLL"


def test_filter_rules(spark):
    ids = spark.createDataFrame([("A.B",), ("A.B.C",), ("A.X",), ("Z",)], "uid string")
    rules = [("include", r"^A\.B$"), ("exclude", r"^A\.(?!X$).*"), ("exclude", r"^A\.B$")]
    assert tuples(cat.apply_filter_rules(ids, rules)) == [("A.B",), ("A.X",), ("Z",)]


def test_changed_pages(spark):
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None)], "path string, content string")
    old = spark.createDataFrame([("a", "1"), ("b", "x"), ("c", None), ("d", "gone")], "path string, content string")
    assert tuples(cat.changed_pages(new, old)) == [("a", "unchanged"), ("b", "modified"), ("c", "unchanged")]


# --- frontier ----------------------------------------------------------------


def xml(*locs, root="urlset", item="url"):
    inner = "".join(f"<{item}><loc>{x}</loc>{m and f'<lastmod>{m}</lastmod>'}</{item}>" for x, m in locs)
    return f'<?xml version="1.0"?>\n<{root} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">{inner}</{root}>'


@pytest.fixture
def site(spark):
    docs = [
        ("https://h/sitemap.xml", 200, " " + xml(("https://h/a.xml", ""), ("https://h/p0", ""), root="sitemapindex", item="sitemap")),
        ("https://h/a.xml", 200, xml(("https://h/p1", "2024-01-01"), ("https://h/b.xml", ""), ("https://h/p2", "2024-01-01T00:00:00Z"))),
        ("https://h/b.xml", 200, xml(("https://h/p3", ""))),
        ("https://h/words/sitemap.xml", 200, xml(("https://h/w1", ""), ("https://h/b.xml", ""))),
        ("https://g/sitemap.xml", 404, xml(("https://g/x.xml", ""))),
        ("https://k/sitemap.xml", 200, "<html>"),
    ]
    hosts = [("h", True), ("g", True), ("k", False)]
    return (
        spark.createDataFrame(docs, "sitemap_url string, status int, body string"),
        spark.createDataFrame(hosts, "subdomain string, has_families boolean"),
    )


def test_expansion(site):
    docs, hosts = site
    out = fr.expand_sitemaps(docs, hosts, ["words", "pdf"])
    got = [r.sitemap_url[8:] for r in out.orderBy(*fr.VISIT_ORDER).collect()]
    # The index is expanded twice, so a.xml comes twice.
    assert got == ["h/sitemap.xml", "h/a.xml", "h/a.xml", "h/b.xml", "h/words/sitemap.xml", "h/b.xml"]
    once = fr.expand_sitemaps(docs, hosts, ["words"], dedupe=True).orderBy(*fr.VISIT_ORDER).collect()
    assert [r.sitemap_url[8:] for r in once] == ["h/sitemap.xml", "h/a.xml", "h/b.xml", "h/words/sitemap.xml"]
    pairs = fr.sitemap_inventory(docs, hosts, ["words"]).orderBy(*fr.VISIT_ORDER).collect()
    # All locations of an index count, and a host without an XML header is taken too.
    assert [r.sitemap_url[8:] for r in pairs if r.site_url == "https://h"] == ["h/sitemap.xml", "h/a.xml", "h/p0", "h/words/sitemap.xml"]
    assert [r.sitemap_url[8:] for r in pairs if r.site_url == "https://k"] == ["k/sitemap.xml"]


def test_frontier_and_batches(spark, site):
    docs, hosts = site
    locs = fr.locations(docs)
    urls = fr.candidate_urls(locs, fr.expand_sitemaps(docs, hosts, ["words"]))
    ledger = spark.createDataFrame([("https://h/p1", datetime(2024, 1, 1)), ("https://h/p2", datetime(2024, 1, 1)), ("https://h/w1", datetime(2024, 2, 10))], "url string, processed_at timestamp")
    now = F.lit("2024-02-15").cast("timestamp")
    names = lambda df: [r.url[8:] for r in df.orderBy(*fr.VISIT_ORDER, "pos").collect()]
    assert names(fr.frontier(urls, ledger, now)) == ["h/p0", "h/p3", "h/p3"]
    assert names(fr.frontier(urls, ledger, now, use_lastmod=True)) == ["h/p0", "h/p1", "h/p1", "h/p3", "h/p3"]
    batches = fr.to_batches(urls, 3).orderBy("batch_no").collect()
    flat = [u for b in batches for u in b.urls]
    assert [len(b.urls) for b in batches][:-1] == [3] * (len(batches) - 1)
    assert flat == ["https://" + u for u in names(urls)]


def test_lastmod_is_strict(values):
    texts = ["2024-01-31", "2024-1-3", "2024-02-31", "2024-01-31T00:00:00Z", " 2024-01-31", "", None]
    assert values(texts, fr.parse_lastmod) == [date(2024, 1, 31), date(2024, 1, 3), None, None, None, None, None]


def test_outcomes(spark):
    rows = [(200, 1), (429, 2), (429, 5), (401, 5), (401, 1), (500, 1), (200, 6)]
    out = fr.classify_outcome(spark.createDataFrame(rows, "status int, attempt int")).collect()
    assert [r.outcome for r in out] == ["done", "retry", "failed", "failed", "retry", "failed", "failed"]
    assert [r.retry_after for r in out] == [None, 4, 32, None, None, None, None]


# --- search index and keywords -----------------------------------------------

DOC = "lang string, family_ord int, page_path string, data map<string,string>, other map<string,string>"


def test_search_merge(spark):
    rows = [
        ("en", 0, "/a", {"h1": "1", "h2": "2"}, {"title": "A0"}), ("en", 1, "/a", {"h2": "22"}, {"title": "A1"}),
        ("en", 2, "/a", None, {"x": "y"}), ("en", 0, "/empty", {}, {}), ("fr", 0, "/a", {"h": "f"}, {}),
    ]
    out = {(r.lang, r.page_path): r for r in merge_search(spark.createDataFrame(rows, DOC)).collect()}
    assert out["en", "/a"].data == {"h1": "1", "h2": "22"} and out["en", "/a"].other == {"title": "A1", "x": "y"}
    assert out["en", "/empty"].data == {} and out["fr", "/a"].data == {"h": "f"}


def test_search_merge_is_associative(spark):
    rows = [("en", i, "/p", {f"k{i % 3}": str(i)}, {"t": str(i)}) for i in range(8)]
    whole = merge_entries(spark.createDataFrame(rows, DOC))
    first = merge_entries(spark.createDataFrame(rows[:5], DOC)).withColumn("family_ord", F.lit(4))
    rest = merge_entries(spark.createDataFrame(rows[5:], DOC)).withColumn("family_ord", F.lit(7))
    two = first.unionByName(rest).groupBy("lang", "page_path", "section", "key").agg(F.max_by("value", "family_ord").alias("value"))
    assert tuples(whole) == tuples(two)


def test_keywords(spark):
    rows = [(["https://h/fr/x", "b"],), (["https://h/fr/x", "a"],), (["https://h/fr/x", "a"],), (["https://h/tag/x", "a"],), (["only"],)]
    out = keywords_by_page(spark.createDataFrame(rows, "keys array<string>"), F.lit("2024-02-15").cast("date")).collect()
    assert [(r.url, r.part, r.keywords, r.lang) for r in out] == [("https://h/fr/x", 0, ["a", "b"], "fr")]


def test_hot_page_keywords_are_whole(spark):
    rows = spark.range(5000).select(F.array(F.lit("https://h/x"), F.col("id").cast("string")).alias("keys"))
    out = keywords_by_page(rows, F.current_date(), size=500).collect()
    assert len(out) == 10 and {len(r.keywords) for r in out} == {500}
    inorder = [k for r in sorted(out, key=lambda r: r.part) for k in r.keywords]
    assert inorder == sorted(map(str, range(5000)))
    assert sorted(k for r in out for k in r.keywords) == sorted(map(str, range(5000)))


def test_updates_json(spark):
    from leafwright.sources.sinks import updates_json

    schema = "family string, nuget string, version string"
    assert [tuple(r) for r in updates_json(spark.createDataFrame([], schema)).collect()] == [(0, "[]")]
    some = spark.createDataFrame([(f"f{i}", "n", "1") for i in range(30)], schema)
    assert len(json.loads(updates_json(some).first().value)) == 30
    parts = [json.loads(r.value) for r in updates_json(some, size=10).orderBy("part").collect()]
    assert [len(p) for p in parts] == [10] * 3
    assert [u["family"] for p in parts for u in p] == sorted(f"f{i}" for i in range(30))
