"""Package catalog: versions, updates, artifacts and API filter rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafwright.functions.text import pattern, pytrim
from leafwright.operators.groups import first_by


def latest_version(versions: Column) -> Column:
    """The last version of a feed, NULL for an empty one."""
    return F.try_element_at(versions, F.lit(-1))


def version_updates(status: DataFrame, feed: DataFrame) -> DataFrame:
    """``family, nuget, version`` of packages whose latest version differs.

    Any difference counts, not only a newer one.  Packages without a name and
    feeds without a version are left out.
    """
    latest = feed.select(F.lower("nuget").alias("nuget"), latest_version(F.col("versions")).alias("latest"))
    known = status.select("family", F.lower("nuget").alias("nuget"), F.col("version").alias("_known"))
    return (
        known.filter(F.coalesce("nuget", F.lit("")) != "")
        .join(latest.filter("latest IS NOT NULL"), "nuget")
        .filter(~F.col("_known").eqNullSafe(F.col("latest")))
        .select("family", "nuget", F.col("latest").alias("version"))
    )


def apply_updates(status: DataFrame, updates: DataFrame) -> DataFrame:
    """Status table with the new versions; other fields stay."""
    new = updates.select("family", F.col("version").alias("_new"))
    return status.join(new, "family", "left").select(
        *[F.coalesce("_new", "version").alias(c) if c == "version" else F.col(c) for c in status.columns]
    )


def parse_products(text: Column) -> Column:
    """Names of a comma list, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(text, ","), pytrim), lambda x: x != "")


def requested_updates(requests: DataFrame, status: DataFrame, column: str = "products") -> DataFrame:
    """Requested products that the status table knows, once each; ``pos`` is the request order.

    ``requests`` may hold ``request_ord`` when there is more than one list.
    """
    ord_col = F.col("request_ord") if "request_ord" in requests.columns else F.lit(0)
    asked = requests.select(
        ord_col.alias("request_ord"), F.posexplode(parse_products(F.col(column))).alias("pos", "family")
    )
    once = first_by(asked, ["family"], ["request_ord", "pos"])
    return once.join(status.select("family", "nuget", "version"), "family").select(
        "request_ord", "pos", "family", "nuget", "version"
    )


def upsert_status(status: DataFrame, done: DataFrame) -> DataFrame:
    """Set version and date of finished packages; a new family gets itself as package name."""
    new = done.select("family", F.col("version").alias("_version"), F.col("processed").alias("_processed"))
    return status.join(new, "family", "full").select(
        "family",
        F.when(F.col("nuget").isNull() & F.col("_version").isNotNull(), F.col("family"))
        .otherwise(F.col("nuget"))
        .alias("nuget"),
        F.coalesce("_version", "version").alias("version"),
        F.coalesce("_processed", "processed").alias("processed"),
    )


def pick_artifacts(listing: DataFrame, keys: Sequence[str] = ("nuget", "family")) -> DataFrame:
    """``keys, xml_path, dll_path, error`` of each package.

    Names are compared without case.  The largest XML wins, the first walked of
    equal ones; of libraries the last walked wins.  A package without either is
    an error row.  Without ``walk_ord`` files are walked in path order.
    """
    order = "walk_ord" if "walk_ord" in listing.columns else "path"
    name = F.lower(F.element_at(F.split("path", "/", -1), -1))

    def named(ext: str) -> Column:
        return name == F.concat(F.lower("family"), F.lit(ext))

    xml, dll = named(".xml"), named(".dll")
    picked = listing.groupBy(*keys).agg(
        F.min_by(F.when(xml, F.col("path")), F.when(xml, F.struct(-F.col("length"), order))).alias("xml_path"),
        F.max_by(F.when(dll, F.col("path")), F.when(dll, F.col(order))).alias("dll_path"),
    )
    missing = F.concat_ws(
        ", ", F.when(F.col("xml_path").isNull(), "XML"), F.when(F.col("dll_path").isNull(), "DLL")
    )
    return picked.withColumn(
        "error", F.when(missing != "", F.concat(F.lit("missing "), missing)).otherwise(F.lit(None))
    )


def matches_rules(uid: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """True when an API id stays: the first matching rule decides, no match keeps it."""
    decide = lambda rule: F.when(uid.rlike(pattern(rule[1])), rule[0] == "include")
    return F.coalesce(*[decide(r) for r in rules], F.lit(True))


def apply_filter_rules(ids: DataFrame, rules: Sequence[tuple[str, str]], uid: str = "uid") -> DataFrame:
    """Keep the API ids that the ordered ``(action, pattern)`` rules include."""
    return ids.filter(matches_rules(F.col(uid), rules)) if rules else ids


def changed_pages(new: DataFrame, published: DataFrame, keys: Sequence[str] = ("path",)) -> DataFrame:
    """``keys, change`` of the new pages: ``added``, ``modified`` or ``unchanged``.

    Contents are hashed before the join, so the shuffle moves hashes and not
    pages.  Pages that are no longer made are not seen.
    """
    now = new.select(*keys, F.sha2("content", 256).alias("_new"))
    old = published.select(*keys, F.sha2("content", 256).alias("_old"), F.lit(True).alias("_there"))
    change = (
        F.when(F.col("_there").isNull(), "added")
        .when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged")
        .otherwise("modified")
    )
    return now.join(old, list(keys), "left").select(*keys, change.alias("change"))


def with_folder(df: DataFrame, folders: DataFrame) -> DataFrame:
    """Add ``folder`` of each family and ``error`` where a family has none."""
    out = df.join(folders.select("family", "folder"), "family", "left")
    return out.withColumn(
        "error", F.when(F.col("folder").isNull(), F.concat(F.lit("no folder for "), F.col("family")))
    )
