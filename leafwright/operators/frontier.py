"""Sitemap frontier: which URLs are to be submitted, in which batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.text import let, pattern, pytrim
from leafwright.operators.groups import first_by, number_in_order

# Sizes and limits of submission.
BATCH_SIZE = 200
RESUBMIT_DAYS = 30
MAX_ATTEMPTS = 5

# Families with a sitemap of their own.
SITEMAP_FAMILIES = tuple("words pdf cells imaging barcode tasks ocr cad html zip page psd tex".split())

SITEMAP_SCHEMA = "url array<struct<loc string, lastmod string>>, sitemap array<struct<loc string, lastmod string>>"

VISIT_ORDER = ("step", "p1", "p2")


def is_sitemap(url: Column) -> Column:
    """True for an address of a sitemap, not of a page."""
    return url.endswith(".xml")


def starts_as_xml(body: Column) -> Column:
    """True for a payload with an XML header."""
    return pytrim(body).startswith("<?xml")


def valid_sitemaps(docs: DataFrame, strict: bool = True) -> DataFrame:
    """Payloads that came with status 200 and (``strict``) an XML header."""
    ok = F.col("status") == 200
    return docs.filter(ok & starts_as_xml(F.col("body")) if strict else ok)


def parse_sitemap(body: Column) -> Column:
    """Locations of a sitemap or sitemap index: array of ``loc, lastmod``; empty for bad XML."""
    none = F.array().cast("array<struct<loc string, lastmod string>>")

    def whole(doc: Column) -> Column:
        found = F.concat(F.coalesce(doc["sitemap"], none), F.coalesce(doc["url"], none))
        return F.when(doc["_corrupt_record"].isNull(), found).otherwise(none)

    return let(F.from_xml(pytrim(body), F.lit(f"{SITEMAP_SCHEMA}, _corrupt_record string")), whole)


def is_sitemap_index(body: Column) -> Column:
    """True when the root element is a sitemap index."""
    root = F.regexp_extract(body, pattern(r"<([A-Za-z_][\w.:-]*)"), 1)
    return root.endswith("sitemapindex")


def locations(docs: DataFrame, strict: bool = True) -> DataFrame:
    """``sitemap_url, is_index, pos, loc, lastmod`` of all valid payloads; one that names nothing has a row without ``loc``."""
    found = valid_sitemaps(docs, strict).filter(is_sitemap(F.col("sitemap_url")))
    entries = found.select(
        "sitemap_url", is_sitemap_index(F.col("body")).alias("is_index"), parse_sitemap(F.col("body")).alias("_locs")
    )
    return entries.select(
        "sitemap_url", "is_index", F.posexplode_outer("_locs").alias("pos", "_l")
    ).select("sitemap_url", "is_index", "pos", F.col("_l.loc").alias("loc"), F.col("_l.lastmod").alias("lastmod"))


def nested_sitemaps(locs: DataFrame, index_test: str = "suffix") -> DataFrame:
    """``sitemap_url, pos, loc`` of the sitemaps named in a sitemap.

    ``index_test`` tells them by the ``.xml`` ending, or takes all locations of
    an index by its ``root`` element.
    """
    keep = is_sitemap(F.col("loc")) if index_test == "suffix" else F.col("is_index")
    return locs.filter(keep & F.col("loc").isNotNull()).select("sitemap_url", "pos", "loc")


def parse_lastmod(text: Column) -> Column:
    """Date of a strict ``yyyy-MM-dd`` text, else NULL."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), F.try_to_date(text, "yyyy-M-d"))


def sitemap_urls(locs: DataFrame) -> DataFrame:
    """``sitemap_url, pos, url, lastmod`` of the pages named in sitemaps."""
    return locs.filter(~is_sitemap(F.col("loc"))).select(
        "sitemap_url", "pos", F.col("loc").alias("url"), "lastmod"
    )


def family_sitemaps(hosts: DataFrame, families: Sequence[str], docs: DataFrame) -> DataFrame:
    """``subdomain, family_ord, sitemap_url`` of the family sitemaps that are there.

    Candidates come from a short literal list, so they are exploded, not cross joined.
    """
    names = F.array(*[F.lit(f) for f in families])
    probes = hosts.select("subdomain", F.posexplode(names).alias("family_ord", "family")).withColumn(
        "sitemap_url", F.concat(F.lit("https://"), "subdomain", F.lit("/"), "family", F.lit("/sitemap.xml"))
    )
    there = docs.filter("status = 200").select("sitemap_url").distinct()
    return probes.join(there, "sitemap_url", "left_semi").select("subdomain", "family_ord", "sitemap_url")


def expand_sitemaps(
    docs: DataFrame,
    hosts: DataFrame,
    families: Sequence[str] = SITEMAP_FAMILIES,
    depth: int = 2,
    index_test: str = "suffix",
    strict: bool = True,
    dedupe: bool = False,
    locs: DataFrame | None = None,
) -> DataFrame:
    """All sitemaps to visit: ``subdomain, step, p1, p2, sitemap_url``; the last three give the order.

    ``hosts`` has ``subdomain`` and ``has_families``.  Step 0 is the index of a
    host, step 1 what it names, step 2 (``depth`` 2) what the sitemaps of steps
    0 and 1 name, step 3 family sitemaps and what they name.  The index is
    expanded in both steps, so its sitemaps come twice unless ``dedupe``.
    ``locs`` takes :func:`locations` that were worked out before; then no body is read here.
    """
    locs = locations(docs, strict) if locs is None else locs
    nested = nested_sitemaps(locs, index_test)
    index_url = F.concat(F.lit("https://"), "subdomain", F.lit("/sitemap.xml"))
    live = locs.select("sitemap_url").distinct()
    zero = F.lit(0)

    def visit(step: int, p1: Column, p2: Column) -> Column:
        big = [p.cast("bigint").alias(n) for p, n in ((p1, "p1"), (p2, "p2"))]
        return F.struct(F.lit(step).alias("step"), *big)

    def visits(df: DataFrame, url: str, *at: Column) -> DataFrame:
        return df.select("subdomain", F.explode(F.array(*at)).alias("_at"), F.col(url).alias("sitemap_url")).select(
            "subdomain", "_at.step", "_at.p1", "_at.p2", "sitemap_url"
        )

    def below(df: DataFrame, url: str, *kept: str) -> DataFrame:
        return df.select("subdomain", *kept, F.col(url).alias("sitemap_url")).join(nested, "sitemap_url")

    roots = hosts.withColumn("sitemap_url", index_url).join(live, "sitemap_url", "left_semi")
    first = below(roots, "sitemap_url")
    # What the index names is visited in step 1, and again in step 2.
    twice = [visit(1, F.col("pos"), zero)] + ([visit(2, zero, F.col("pos"))] if depth >= 2 else [])
    out = visits(roots, "sitemap_url", visit(0, zero, zero)).unionByName(visits(first, "loc", *twice))
    if depth >= 2:
        second = below(first.withColumn("src", F.col("pos") + 1), "loc", "src")
        out = out.unionByName(visits(second, "loc", visit(2, F.col("src"), F.col("pos"))))
    own = family_sitemaps(roots.filter("has_families").select("subdomain"), families, docs)
    named = below(own, "sitemap_url", "family_ord")
    out = out.unionByName(visits(own, "sitemap_url", visit(3, F.col("family_ord"), zero)))
    out = out.unionByName(visits(named, "loc", visit(3, F.col("family_ord"), F.col("pos") + 1)))
    return first_by(out, ["subdomain", "sitemap_url"], VISIT_ORDER) if dedupe else out


def sitemap_inventory(docs: DataFrame, hosts: DataFrame, families: Sequence[str] = SITEMAP_FAMILIES) -> DataFrame:
    """``site_url, sitemap_url, step, p1, p2``: pairs to submit, one level below each index."""
    found = expand_sitemaps(docs, hosts, families, depth=1, index_test="root", strict=False)
    return found.select(
        F.concat(F.lit("https://"), "subdomain").alias("site_url"), "sitemap_url", *VISIT_ORDER
    )


def candidate_urls(locs: DataFrame, visits: DataFrame) -> DataFrame:
    """URLs of all visited sitemaps, in visit order; a sitemap visited twice gives its URLs twice."""
    return visits.join(sitemap_urls(locs), "sitemap_url")


def frontier(
    urls: DataFrame, ledger: DataFrame, now: Column, days: int = RESUBMIT_DAYS, use_lastmod: bool = False
) -> DataFrame:
    """URLs not processed yet and, with ``use_lastmod``, those due again.

    A URL is due again when it has a change date and was processed more than
    ``days`` ago.  The default looks at the ledger only.
    """
    if not use_lastmod:
        return urls.join(ledger.select("url"), "url", "left_anti")
    old = F.col("processed_at") < now - F.make_dt_interval(F.lit(days))
    due = parse_lastmod(F.col("lastmod")).isNotNull() & old
    known = ledger.select("url", "processed_at")
    return urls.join(known, "url", "left").filter(F.col("processed_at").isNull() | due).drop("processed_at")


def to_batches(
    urls: DataFrame,
    size: int = BATCH_SIZE,
    block: Sequence[str] = VISIT_ORDER,
    order: Sequence[str] = ("pos",),
) -> DataFrame:
    """``subdomain, batch_no, urls``: batches of ``size`` URLs per host, order kept.

    Numbers are worked out per sitemap, so one host with most URLs is still
    spread over many tasks.
    """
    numbered = number_in_order(urls, ["subdomain"], block, order)
    rows = numbered.select(
        "subdomain", F.floor((F.col("rn") - 1) / size).cast("bigint").alias("batch_no"), "rn", "url"
    )
    packed = rows.groupBy("subdomain", "batch_no").agg(F.array_sort(F.collect_list(F.struct("rn", "url"))).alias("_b"))
    return packed.select("subdomain", "batch_no", F.transform("_b", lambda x: x["url"]).alias("urls"))


def explode_batches(batches: DataFrame) -> DataFrame:
    """``subdomain, batch_no, pos, url`` of batches."""
    return batches.select("subdomain", "batch_no", F.posexplode("urls").alias("pos", "url"))


def classify_outcome(df: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Add ``outcome`` (``done``, ``retry``, ``failed``), ``ok`` and ``retry_after`` seconds.

    Lost logins and rate limits are tried again, up to ``max_attempts``.
    """
    again = F.col("status").isin(401, 429) & (F.col("attempt") < max_attempts)
    outcome = (
        F.when(F.col("attempt") > max_attempts, "failed")
        .when(F.col("status") == 200, "done")
        .when(again, "retry")
        .otherwise("failed")
    )
    wait = F.when(
        (F.col("status") == 429) & (F.col("attempt") <= max_attempts), F.pow(F.lit(2), F.col("attempt")).cast("bigint")
    )
    return df.select("*", outcome.alias("outcome")).select(
        "*", (F.col("outcome") == "done").alias("ok"), wait.alias("retry_after")
    )


def submission_counts(outcomes: DataFrame) -> DataFrame:
    """Submitted URLs of each batch."""
    return outcomes.groupBy("subdomain", "batch_no").agg(F.count_if("ok").alias("submitted"))
