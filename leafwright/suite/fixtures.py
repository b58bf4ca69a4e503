"""Inputs of the registered queries, derived from the driver tables by rules on ids.

Each fixture is one SELECT in the SQL that Spark and DuckDB share, so a query
and its oracle start from the same rows.  Arrays, maps and XML, which the two
write differently, are put on in :mod:`leafwright.suite.inputs`.
"""

from __future__ import annotations

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

NOW = "2024-02-15 00:00:00"

NL = "chr(10)"
_FLAT = "replace(replace(replace(replace(text, chr(10), ' '), '\"', ''), '''', ''), ':', '')"


def _lines(*parts: str) -> str:
    return " || ".join(parts)


def _when(test: str, text: str) -> str:
    return f"CASE WHEN {test} THEN {text} ELSE '' END"


_TAGS = "".join(
    f"  - {t}\n"
    for t in ("tag-aa", "acme-b", "pdf-cc", "tag-dd", "tag-ee", "tag-ff", "tag-gg", "tag-hh", "tag-ii", "tag-jj", "tag-kk")
)
_TAGS_SQL = "'" + _TAGS.replace("\n", "' || chr(10) || '") + "'"
_TAG_LINE = len("  - tag-aa\n")

_TITLE = (
    "CASE WHEN doc_id % 13 = 0 THEN '' "
    f"WHEN doc_id % 31 = 0 THEN 'title:' || {NL} "
    f"WHEN doc_id % 29 = 0 THEN 'title: ' || verb || ': ' || substr(flat, 1, 20) || {NL} "
    f"ELSE 'title: \"' || verb || ' ' || substr(flat, 1, 20) || '\"' || {NL} END"
)

_FM = _lines(
    f"'---' || {NL}",
    _TITLE,
    _when("doc_id % 7 <> 0", f"'layout: \"reference-single\"' || {NL}"),
    _when("doc_id % 19 <> 0", f"'categories:' || {NL} || '  - Class' || {NL}"),
    f"'description: \"' || substr(flat, 1, CAST(20 + doc_id % 160 AS INT)) || '\"' || {NL}",
    _when("doc_id % 5 <> 0", f"'summary: \"' || substr(flat, 1, 30) || '\"' || {NL}"),
    "'seoTitle: \"' || substr("
    + _when("doc_id % 2 = 0", "'Acme '")
    + " || "
    + _when("doc_id % 37 = 0", "'reader reader reader '")
    + f" || flat || repeat(' ab', 24), 1, CAST(20 + doc_id % 50 AS INT)) || '\"' || {NL}",
    _when("doc_id % 3 <> 0", f"'url: /x/' || CAST(doc_id AS STRING) || '/' || {NL}"),
    _when(
        "doc_id % 12 > 0",
        f"'tags:' || {NL} || replace(substr({_TAGS_SQL}, 1, CAST({_TAG_LINE} * (doc_id % 12) AS INT)), "
        "'tag-aa', CASE WHEN doc_id % 17 = 0 THEN 'Tag-aa' ELSE 'tag-aa' END)",
    ),
    f"'---' || {NL}",
)

_BODY = _lines(
    _when("doc_id % 27 = 0", f"'Note.' || {NL}"),
    _when("doc_id % 9 = 0", f"'{{{{< blocks/products/pf/main-wrap-class >}}}}' || {NL}"),
    f"text || {NL}",
    _when(
        "doc_id % 2 = 0",
        f"{NL} || CASE WHEN doc_id % 4 = 0 THEN '## Раздел' ELSE '## Section' END || {NL}",
    ),
    _when(
        "doc_id % 3 = 0",
        f"{NL} || '| A | B |' || {NL} || '| --- | --- |' || {NL} || "
        f"CASE WHEN doc_id % 6 = 0 THEN '| 1 |' ELSE '| 1 | 2 |' END || {NL}",
    ),
    _when("doc_id % 15 = 0", f"{NL} || '| A | B | C |' || {NL} || '| 1 | 2 | 3 |' || {NL}"),
    _when("doc_id % 3 = 1", f"{NL} || '```csharp' || {NL} || 'x = 1;' || {NL} || '```' || {NL}"),
    _when("doc_id % 10 = 0", f"'<pre>x' || {NL}"),
    _when("doc_id % 10 = 5", f"'<pre>x</pre>' || {NL}"),
    _when("doc_id % 23 = 0", f"'<xref:X>' || {NL}"),
    _when("doc_id % 43 = 0", f"'uid: X' || {NL}"),
    _when("doc_id % 4 <> 3", f"'Assembly: Acme.Words.dll' || {NL}"),
    _when("doc_id % 8 = 0", f"'[a](b.md)' || {NL}"),
    _when("doc_id % 8 = 4", f"'[a](/b/)' || {NL}"),
    _when("doc_id % 8 = 2", f"'[a](https://x/y.md)' || {NL}"),
    _when("doc_id % 16 = 6", f"'[a](b.html)' || {NL}"),
    _when("doc_id % 47 = 0", f"'TODO' || {NL}"),
    _when("doc_id % 9 = 0", f"'{{{{< /blocks/products/pf/main-wrap-class >}}}}' || {NL}"),
    _when("doc_id % 36 = 0", f"'{{{{< blocks/products/products-backtop-button >}}}}' || {NL}"),
    _when("doc_id % 18 = 0", f"'After.' || {NL}"),
)

PAGE = f"""
SELECT doc_id, source AS family, lang,
       lang || '/' || source || '/' || CAST(doc_id AS STRING) || '.md' AS path,
       {_when("doc_id % 11 <> 0", _FM)} || CASE WHEN doc_id % 41 = 0 THEN '' ELSE {_BODY} END AS content
FROM (
  SELECT doc_id, text, lang, source, {_FLAT} AS flat,
         CASE doc_id % 4 WHEN 0 THEN 'Convert' WHEN 1 THEN 'Create' WHEN 2 THEN 'Guide' ELSE 'Overview' END AS verb
  FROM documents
) d
"""

# Change sets: five documents each, three products. 
CHANGE_SET = """
SELECT 'https://host.example/acme/' || product AS repo_url, pr_number, product, product_ord,
       'Update ' || CAST(pr_number AS STRING) AS title,
       CASE WHEN pr_number % 6 = 0 THEN 'fix-' ELSE 'api-update-' END || CAST(pr_number AS STRING) AS head_ref,
       pr_number % 4 = 0 AS has_docs_label,
       CAST(timestamp '2024-01-01 00:00:00' + interval '1' hour * CAST(pr_number AS INT) AS TIMESTAMP) AS created_at,
       CAST(timestamp '2024-01-02 00:00:00' + interval '1' hour * CAST(pr_number AS INT) AS TIMESTAMP) AS updated_at
FROM (
  SELECT pr_number, CAST(pr_number % 3 AS INT) AS product_ord,
         CASE pr_number % 3 WHEN 0 THEN 'words' WHEN 1 THEN 'viewer' ELSE 'other-tools2' END AS product
  FROM (SELECT DISTINCT CAST(FLOOR(doc_id / 5.0) AS BIGINT) AS pr_number FROM documents) n
) p
"""

CHANGED_FILE = f"""
SELECT 'https://host.example/acme/' ||
         CASE CAST(FLOOR(doc_id / 5.0) AS BIGINT) % 3 WHEN 0 THEN 'words' WHEN 1 THEN 'viewer' ELSE 'other-tools2' END
         AS repo_url,
       CAST(FLOOR(doc_id / 5.0) AS BIGINT) AS pr_number, doc_id, doc_id % 5 AS file_ord,
       CASE doc_id % 6 WHEN 0 THEN 'Docs/net/' WHEN 1 THEN 'docs/java/' WHEN 2 THEN 'docs/net/python/'
                       ELSE 'docs/' END || CAST(doc_id AS STRING) || CASE WHEN doc_id % 14 = 0 THEN '.png' ELSE '.md' END AS path,
       CASE WHEN doc_id % 9 = 0 THEN 'removed' WHEN doc_id % 9 = 1 THEN 'renamed'
            WHEN doc_id % 9 < 5 THEN 'added' ELSE 'modified' END AS status,
       CASE WHEN doc_id % 6 = 0 THEN NULL
            WHEN doc_id % 6 = 1 THEN '@@ -1,3 +1,3 @@' || chr(10) || ' a' || chr(10) || '@@ -200 +900,2 @@'
            WHEN doc_id % 6 = 2 THEN ''
            ELSE '@@ -2 +2 @@ x' END AS patch,
       CASE WHEN doc_id % 53 = 0 THEN NULL ELSE content END AS content
FROM ({PAGE}) pg
"""

REVIEW_STATE = f"""
SELECT repo_url, pr_number, product,
       CASE pr_number % 4 WHEN 0 THEN 'APPROVE' WHEN 1 THEN 'REQUEST_CHANGES' WHEN 2 THEN 'REJECT' ELSE 'OTHER' END AS decision,
       CAST(pr_number % 101 AS INT) AS score,
       CAST(timestamp '2024-02-01 00:00:00' + interval '1' hour * CAST(pr_number % 400 AS INT) AS TIMESTAMP) AS reviewed_at,
       CASE WHEN pr_number % 6 = 0 THEN updated_at - interval '1' hour ELSE updated_at END AS pr_updated_at
FROM ({CHANGE_SET}) cs WHERE pr_number % 3 = 0
"""

AI_RESPONSE = """
SELECT doc_id,
       CASE WHEN doc_id % 13 = 0 THEN '{"score": '
            ELSE '{"score": ' ||
              CASE WHEN doc_id % 11 = 0 THEN '85.7' WHEN doc_id % 7 = 0 THEN '"85.7"'
                   WHEN doc_id % 5 = 0 THEN '"' || CAST(doc_id % 120 - 10 AS STRING) || '"'
                   ELSE CAST(doc_id % 120 - 10 AS STRING) END ||
              ', "clarity": ' || CAST(doc_id % 21 AS STRING) ||
              ', "summary": "fine", "strengths": ["s' || CAST(doc_id % 3 AS STRING) || '"]' ||
              ', "issues": ["i' || CAST(doc_id % 4 AS STRING) || '", "i' || CAST(doc_id % 7 AS STRING) || '"]' ||
              ', "recommendation": "' || CASE WHEN doc_id % 3 = 0 THEN 'MAYBE' ELSE 'APPROVE' END || '"}' END AS body,
       CAST(100 + doc_id % 50 AS INT) AS total_tokens,
       CASE WHEN doc_id % 11 = 0 THEN 85 WHEN doc_id % 7 = 0 THEN 0 ELSE doc_id % 120 - 10 END AS true_score
FROM documents
"""

PACKAGE_STATUS = """
SELECT s_name AS family, CASE WHEN s_suppkey % 20 = 0 THEN '' ELSE 'Acme.' || s_name END AS nuget,
       '25.' || CAST(s_suppkey % 12 AS STRING) || '.0' AS version, DATE '2024-01-10' AS processed, s_suppkey AS k
FROM supplier
"""

VERSION_FEED = """
SELECT lower('Acme.' || s_name) AS nuget,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE '24.1.0' END AS v1,
       CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 3 = 0 THEN '26.0.' || CAST(s_suppkey % 7 AS STRING)
            ELSE '25.' || CAST(s_suppkey % 12 AS STRING) || '.0' END AS v2
FROM supplier WHERE s_suppkey % 25 <> 0
"""

# One request list per four suppliers: blanks, repeats and an unknown name.
REQUESTED = """
SELECT s_suppkey AS request_ord,
       ' ' || s_name || ', ,nobody' || CAST(s_suppkey AS STRING) || ',' || s_name || ',Supplier#' ||
       substr(CAST(1000000001 + s_suppkey AS STRING), 2) AS products,
       s_name AS first_name, 'Supplier#' || substr(CAST(1000000001 + s_suppkey AS STRING), 2) AS second_name
FROM supplier WHERE s_suppkey % 4 = 0
"""

ARTIFACT = """
SELECT p_brand AS nuget, 'Acme.' || p_brand AS family,
       'pkg/' || p_brand || '/lib' || CAST(p_partkey AS STRING) || '/' ||
         CASE WHEN p_partkey % 2 = 0 THEN 'ACME.' ELSE 'Acme.' END || p_brand ||
         CASE p_partkey % 3 WHEN 0 THEN '.xml' WHEN 1 THEN '.DLL' ELSE '.txt' END AS path,
       CAST(p_size AS BIGINT) AS length, p_partkey AS walk_ord
FROM part WHERE NOT (p_brand = 'Brand#7' AND p_partkey % 3 = 0)
"""

API_ID = """
SELECT p_partkey, 'Acme.' || replace(p_type, ' ', '.') || '.' || replace(p_name, ' ', '.') AS uid FROM part
"""

# Eight families share a page; no family has a page twice.
SEARCH_DOC = """
SELECT doc_id, lang, 'f' || CAST(doc_id % 8 AS STRING) AS family, CAST(doc_id % 8 AS INT) AS family_ord,
       '/p/' || CAST(CAST(FLOOR(doc_id / 8.0) AS BIGINT) AS STRING) || '/' AS page_path,
       doc_id % 5 <> 0 AS has_data,
       'h' || CAST(doc_id % 6 AS STRING) AS key1, '"' || CAST(doc_id AS STRING) || '"' AS value1,
       'h' || CAST((doc_id + 1) % 6 AS STRING) AS key2, '"x' || CAST(doc_id AS STRING) || '"' AS value2,
       '"T' || CAST(doc_id AS STRING) || '"' AS title
FROM documents
"""

QUERY_ROW = """
SELECT e.event_id, e.ts,
       CASE WHEN e.event_id % 33 = 0 THEN replace(p.url, '.example.', '.example/tag/.') ELSE p.url END AS k1,
       CASE WHEN e.event_id % 50 = 0 THEN NULL
            ELSE e.event_type || ' ' || CAST(e.user_id % 10 AS STRING) END AS k2
FROM events e JOIN pages p ON p.page_id = CAST(FLOOR(e.event_id / 40.0) AS BIGINT)
"""

# Hosts of 100 pages with four sitemaps of 25: two in the index, one named by
# the second of these, and one of a family.
SITEMAP_PAGE = """
SELECT 'h' || CAST(host AS STRING) || '.example.org' AS subdomain, host, sm, pos, url, lastmod,
       'https://h' || CAST(host AS STRING) || '.example.org/' ||
         CASE sm WHEN 3 THEN 'words/sitemap.xml' ELSE 'sm-' || CAST(sm AS STRING) || '.xml' END AS sitemap_url,
       CASE WHEN host % 5 = 4 AND sm = 1 THEN 404 ELSE 200 END AS status,
       host % 7 = 1 AND sm = 0 AS bad_xml
FROM (
  SELECT CAST(FLOOR(page_id / 100.0) AS BIGINT) AS host, CAST(FLOOR((page_id % 100) / 25.0) AS BIGINT) AS sm,
         page_id % 25 AS pos, url,
         CASE WHEN page_id % 5 = 0 THEN NULL
              WHEN page_id % 7 = 0 THEN '2024-01-20T00:00:00Z' ELSE '2024-01-20' END AS lastmod
  FROM pages
) p
"""

LEDGER = """
SELECT url, page_id,
       CAST(timestamp '2024-01-01 00:00:00' + interval '1' day * CAST(page_id % 40 AS INT) AS TIMESTAMP) AS processed_at
FROM pages WHERE page_id % 3 = 0
"""

OUTCOME = """
SELECT 'h' || CAST(CAST(FLOOR(p.page_id / 100.0) AS BIGINT) AS STRING) || '.example.org' AS subdomain,
       CAST(FLOOR((p.page_id % 100) / 10.0) AS BIGINT) AS batch_no, p.url, e.event_id,
       CASE e.event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 429 WHEN 'purchase' THEN 401 ELSE 200 END AS status,
       CAST(1 + e.event_id % 6 AS INT) AS attempt
FROM events e JOIN pages p ON p.page_id = CAST(FLOOR(e.event_id / 40.0) AS BIGINT)
"""

PUBLISHED = f"""
SELECT path, CASE WHEN doc_id % 6 = 1 THEN content || 'old' ELSE content END AS content
FROM ({PAGE}) pg WHERE doc_id % 4 <> 0
"""

# Raw generated pages: every seventh is the home page of its family.  A block in two languages never follows another
# C# block here: the rule for it, as shipped, starts at the first such block of a page (tests/test_cleanup.py).
RAW_PAGE = """
SELECT p_partkey, 'Acme.' || replace(p_brand, '#', '') AS family_name, '25.' || CAST(p_partkey % 12 AS STRING) AS version,
       CASE WHEN p_partkey % 7 = 0 THEN 'Acme.' || replace(p_brand, '#', '') ELSE 'P' || CAST(p_partkey AS STRING) END || '.md' AS name,
       CASE WHEN p_partkey % 4 = 0 THEN 'Namespace' ELSE 'Class' END AS kind,
       '# <a id="x"></a> ' || CASE WHEN p_partkey % 4 = 0 THEN 'Namespace N' ELSE 'Class N' END || CAST(p_partkey AS STRING) || chr(10) ||
       chr(10) || 'Namespace: [Acme.' || replace(p_brand, '#', '') || '](Acme.' || replace(p_brand, '#', '') || '.md)' || chr(10) ||
       'Assembly: Acme.' || replace(p_brand, '#', '') || '.dll' || chr(10) || chr(10) ||
       'A ' || p_name || ' <b>kind</b>' || chr(10) || 'of part.' || chr(10) || chr(10) || '```csharp' || chr(10) || 'x' || chr(10) || '```' || chr(10) ||
       CASE WHEN p_partkey % 3 = 0 THEN '<pre><code class="lang-csharp">[C#] one(' || CAST(p_size AS STRING) || ');</code></pre>' || chr(10) ELSE '' END ||
       CASE WHEN p_partkey % 3 = 1 THEN '<pre><code class="lang-csharp">a' || chr(10) || 'b</code></pre>' || chr(10) ELSE '' END ||
       CASE p_partkey % 11
            WHEN 1 THEN '<example><pre><code class="lang-csharp">e1</code></pre></example>' || chr(10)
            WHEN 2 THEN CASE WHEN p_partkey % 3 = 0 THEN '' ELSE
              '<pre><code class="lang-csharp">[C#] c1' || chr(10) || '[Visual Basic] v1</code></pre>' || chr(10) END
            WHEN 3 THEN '<pre>a</attachedfile>b</pre>' || chr(10)
            WHEN 4 THEN 'x [VB.NET] y' || chr(10)
            WHEN 5 THEN '<example>Text <pre><code class="lang-csharp">t1</code></pre></example>' || chr(10)
            ELSE '' END ||
       CASE WHEN p_partkey % 5 = 0 THEN 'See <xref href="Sys.T%601"><b>t</b> &copy;</xref> here.' || chr(10) ELSE '' END ||
       CASE WHEN p_partkey % 6 = 0 THEN 'Go to [L](X/' || p_brand || '.md) or [M](https://a/b.md).' || chr(10) ELSE '' END ||
       chr(10) || '## ' || CASE p_partkey % 5 WHEN 1 THEN 'Structs' WHEN 2 THEN 'Delegates' WHEN 3 THEN 'Interfaces' WHEN 4 THEN 'Enums' ELSE 'Classes' END ||
       chr(10) || chr(10) || '[A](Acme.A.md)' || chr(10) || chr(10) || 'First thing.' || chr(10) || chr(10) ||
       '[B' || CAST(p_partkey AS STRING) || '](B.md)' || chr(10) || chr(10) || '### Namespaces' || chr(10) || chr(10) || '[N](Acme.N.md)' || chr(10)
       AS content
FROM part
"""

PRODUCT_DIM = """
SELECT DISTINCT product, CASE product WHEN 'words' THEN 'Acme.Words' WHEN 'viewer' THEN 'AcmeView.Viewer' END AS display,
       CASE product WHEN 'viewer' THEN 'acmeview.example' END AS website
FROM ({CHANGE_SET}) cs
""".replace("{CHANGE_SET}", CHANGE_SET)

# What calls to the outside came to; the repository of one product is not there.
CALL = """
SELECT repo_url, pr_number, call, attempt, ok, CASE WHEN NOT ok THEN call || ' refused' END AS error FROM (
  SELECT repo_url, pr_number, 'review' AS call, 1 AS attempt, pr_number % 10 <> 3 AS ok FROM ({CHANGE_SET}) a
  UNION ALL SELECT repo_url, pr_number, 'review', 2, pr_number % 20 = 3 FROM ({CHANGE_SET}) b WHERE pr_number % 10 = 3
  UNION ALL SELECT repo_url, pr_number, 'merge', 1, pr_number % 8 <> 4 FROM ({CHANGE_SET}) c
  UNION ALL SELECT repo_url, pr_number, 'files', 1, pr_number % 25 <> 1 FROM ({CHANGE_SET}) d
  UNION ALL SELECT repo_url, pr_number, 'labels', 1, pr_number % 5 <> 0 FROM ({CHANGE_SET}) e
) calls
UNION ALL SELECT 'https://host.example/acme/cells', CAST(NULL AS BIGINT), 'repository', 1, false, 'no such repository'
""".replace("{CHANGE_SET}", CHANGE_SET)

# The configured products: those with change sets, one that cannot be reached and one without change sets.
PRODUCT = """
SELECT DISTINCT product, product_ord, repo_url FROM ({CHANGE_SET}) cs
UNION ALL SELECT 'cells', 3, 'https://host.example/acme/cells'
UNION ALL SELECT 'slides', 4, 'https://host.example/acme/slides'
""".replace("{CHANGE_SET}", CHANGE_SET)
