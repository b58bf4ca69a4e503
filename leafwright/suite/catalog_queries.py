"""Queries over the package catalog and published pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafwright.operators import catalog as cat
from leafwright.sources.sinks import updates_json
from leafwright.suite import fixtures as fx
from leafwright.suite.inputs import feeds, fixture, pages

# Rules for the fixture ids: two included prefixes, the rest of the brand excluded.
RULES = (
    ("include", r"^Acme\.STANDARD(?:$|\..+)"),
    ("exclude", r"^Acme\.(?:ECONOMY|PROMO)\.small\..*$"),
    ("include", r"^Acme\.(ECONOMY|LARGE)(\..*)?$"),
    ("exclude", r"^Acme(?:$|\..+)"),
)
LOOKAHEAD_RULES = (("exclude", r"^Acme\.(?!STANDARD(?:$|\..+)|ECONOMY(?:$|\..+)).+$"),)

_STATUS = ("family", "nuget", "version", "processed")


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, "package_status").select(*_STATUS)


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("processed", F.date_format("processed", "yyyy-MM-dd"))


def version_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages with another version in their feed."""
    return cat.version_updates(_status(spark, sf_dir), feeds(spark, sf_dir))


def status_after_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status table with the versions of the feed."""
    status = _status(spark, sf_dir)
    return _text(cat.apply_updates(status, cat.version_updates(status, feeds(spark, sf_dir))))


def requested_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested packages that are known, once each."""
    found = cat.requested_updates(
        fixture(spark, sf_dir, "requested").select("request_ord", "products"), _status(spark, sf_dir)
    )
    return found.select("request_ord", F.col("pos").cast("bigint").alias("pos"), "family", "nuget", "version")


def updates_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update list as one JSON array."""
    updates = cat.version_updates(_status(spark, sf_dir), feeds(spark, sf_dir))
    return updates_json(updates)


def status_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status table after some packages were processed, one of them new."""
    base = fixture(spark, sf_dir, "package_status")
    done = base.filter("k % 4 = 1").select(
        F.when(F.col("k") % 8 == 1, F.concat("family", F.lit("-new"))).otherwise(F.col("family")).alias("family"),
        F.lit("26.1.0").alias("version"),
        F.lit("2024-02-15").cast("date").alias("processed"),
    )
    return _text(cat.upsert_status(base.select(*_STATUS), done))


def artifact_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Library and documentation file of each package."""
    return cat.pick_artifacts(fixture(spark, sf_dir, "artifact"))


def api_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API ids that the rules keep."""
    return cat.apply_filter_rules(fixture(spark, sf_dir, "api_id"), RULES)


def api_filter_lookahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API ids kept by a rule with a lookahead."""
    return cat.apply_filter_rules(fixture(spark, sf_dir, "api_id"), LOOKAHEAD_RULES)


def changed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New pages against published ones."""
    return cat.changed_pages(pages(spark, sf_dir).select("path", "content"), fixture(spark, sf_dir, "published"))


def family_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder of each family, errors where there is none."""
    status = _status(spark, sf_dir)
    folders = fixture(spark, sf_dir, "package_status").filter("k % 10 <> 3").select(
        "family", F.concat(F.lit("content/"), F.lower("family")).alias("folder")
    )
    return cat.with_folder(status.select("family"), folders)


# --- the same in SQL ---------------------------------------------------------

_S = f"({fx.PACKAGE_STATUS}) s"
_UPDATES = f"""SELECT s.family, lower(s.nuget) AS nuget, f.v2 AS version FROM {_S}
JOIN ({fx.VERSION_FEED}) f ON f.nuget = lower(s.nuget) WHERE s.nuget <> '' AND f.v2 IS NOT NULL AND f.v2 <> s.version"""
_KEPT = r"""regexp_matches(uid, '^Acme\.STANDARD(?:$|\..+)') OR (
  NOT regexp_matches(uid, '^Acme\.(?:ECONOMY|PROMO)\.small\..*$') AND (regexp_matches(uid, '^Acme\.(ECONOMY|LARGE)(\..*)?$')
  OR NOT regexp_matches(uid, '^Acme(?:$|\..+)')))"""

QUERIES = {
    "version_updates": (version_updates, _UPDATES),
    "status_after_updates": (
        status_after_updates,
        f"""SELECT s.family, s.nuget, coalesce(u.version, s.version) AS version, '2024-01-10' AS processed
        FROM {_S} LEFT JOIN ({_UPDATES}) u ON u.family = s.family""",
    ),
    "requested_updates": (
        requested_updates,
        f"""WITH r AS ({fx.REQUESTED}),
        n AS (SELECT request_ord, 0 AS pos, first_name AS family FROM r UNION ALL SELECT request_ord, 3, second_name FROM r),
        o AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY request_ord, pos) AS rn FROM n)
        SELECT request_ord, CAST(pos AS BIGINT) AS pos, family, nuget, version FROM o JOIN {_S} USING (family) WHERE rn = 1""",
    ),
    "updates_as_json": (
        updates_as_json,
        f"""SELECT CAST(0 AS BIGINT) AS part, '[' || coalesce(string_agg('{{"family":"' || family || '","nuget":"' || nuget || '","version":"' || version || '"}}', ','
        ORDER BY family), '') || ']' AS value FROM ({_UPDATES}) u""",
    ),
    "status_upsert": (
        status_upsert,
        f"""SELECT family, nuget, CASE WHEN k % 8 = 5 THEN '26.1.0' ELSE version END AS version,
        CASE WHEN k % 8 = 5 THEN '2024-02-15' ELSE '2024-01-10' END AS processed FROM {_S}
        UNION ALL SELECT family || '-new', family || '-new', '26.1.0', '2024-02-15' FROM {_S} WHERE k % 8 = 1""",
    ),
    "artifact_pick": (
        artifact_pick,
        f"""WITH x AS (SELECT nuget, family, arg_max(path, length * 1000000000 - walk_ord) FILTER (ends_with(lower(path), '.xml')) AS xml_path,
        arg_max(path, walk_ord) FILTER (ends_with(lower(path), '.dll')) AS dll_path FROM ({fx.ARTIFACT}) a GROUP BY nuget, family)
        SELECT *, CASE WHEN xml_path IS NULL AND dll_path IS NULL THEN 'missing XML, DLL' WHEN xml_path IS NULL THEN 'missing XML'
        WHEN dll_path IS NULL THEN 'missing DLL' END AS error FROM x""",
    ),
    "api_filter": (api_filter, f"SELECT * FROM ({fx.API_ID}) a WHERE {_KEPT}"),
    "api_filter_lookahead": (
        api_filter_lookahead,
        rf"SELECT * FROM ({fx.API_ID}) a WHERE regexp_matches(uid, '^Acme\.(STANDARD|ECONOMY)(?:$|\..+)')",
    ),
    "changed_pages": (
        changed_pages,
        f"""SELECT path, CASE WHEN doc_id % 4 = 0 THEN 'added' WHEN doc_id % 6 = 1 THEN 'modified' ELSE 'unchanged' END AS change
        FROM ({fx.PAGE}) p""",
    ),
    "family_folders": (
        family_folders,
        f"""SELECT family, CASE WHEN k % 10 <> 3 THEN 'content/' || lower(family) END AS folder,
        CASE WHEN k % 10 = 3 THEN 'no folder for ' || family END AS error FROM {_S}""",
    ),
}
