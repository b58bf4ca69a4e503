"""Readers and writers over files."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from leafwright.operators import frontier as fr
from leafwright.operators.catalog import pick_artifacts
from leafwright.operators.search_index import merge_search
from leafwright.sources import readers as rd
from leafwright.sources import sinks as sk
from leafwright.sources.json_map import read_json_map
from leafwright.suite import io_queries


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_pages(spark, tmp_path):
    put(tmp_path / "words" / "A.md", "# A\r\nü\n")
    put(tmp_path / "pdf" / "B.md", "b")
    put(tmp_path / "pdf" / "B.txt", "no")
    rows = rd.read_pages(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r.family, r.name, r.content) for r in rows] == [("words", "A.md", "# A\r\nü\n"), ("pdf", "B.md", "b")]
    out = tmp_path / "out"
    sk.export_pages(rd.read_pages(spark, str(tmp_path / "words")), str(out))
    assert (out / "words" / "A.md").read_bytes() == "# A\r\nü\n".encode()
    sk.write_pages(rd.read_pages(spark, str(tmp_path / "words")), str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).first().family == "words"


def test_exported_pages_are_whole_or_not_there(spark, tmp_path):
    """A task that fails leaves nothing; one that runs twice leaves each file once."""
    rows = [("f", f"{i}.md", "x" * i) for i in range(40)]
    df = spark.createDataFrame(rows, "family string, name string, content string").repartition(4)
    out = tmp_path / "out"

    @F.udf("string")
    def broken(name, content):
        if name == "17.md":
            raise ValueError("lost")
        return content

    with pytest.raises(Exception, match="lost"):
        sk.export_pages(df.withColumn("content", broken("name", "content")), str(out))
    assert [p for p in out.rglob("*") if p.is_file()] == [] and not list(out.glob("_staging*"))
    for _ in range(2):
        assert sk.export_pages(df, str(out)) == 40
        assert {p.name: p.read_text() for p in out.rglob("*") if p.is_file()} == {n: c for _, n, c in rows}
    assert sk.export_pages(df.limit(0), str(tmp_path / "none")) == 0
    with pytest.raises(Exception, match="not below"):
        sk.export_pages(spark.createDataFrame([("..", "a.md", "x")], "family string, name string, content string"), str(out))


def test_home_pages_are_exported_and_read_back(spark, tmp_path):
    """Every page comes back, the home pages too; of pages of one name the last is there."""
    rows = [("a", "_index.md", "first", 1), ("a", "_index.md", "last", 3), ("a", "_index.md", "Ü", 2), ("b", "_index.md", "b", None)]
    rows += [("b", "_index.md", "a", None), ("b", "__x.md", "", 1), ("b", "p.md", None, 9), ("b", "p.md", "p", 1), ("b", "q.md", None, 1)]
    rows += [(".net", "_.md", "", 1), ("_b+ %2", ".x ü.md", "x", 1)]
    df = spark.createDataFrame(rows, "family string, name string, content string, n int").repartition(5)
    plain = {("a", "_index.md", "last"), ("b", "_index.md", "b"), ("b", "__x.md", ""), ("b", "p.md", "p")}
    out = tmp_path / "out"
    assert sk.export_pages(df, str(out), order=["n"]) == 6
    put(out / f"_staging-{'0' * 32}" / "a" / "z.md", "not yet")
    read = lambda **k: [(r.family, r.name, r.content) for r in rd.read_pages(spark, str(out), **k).collect()]
    assert sorted(read()) == sorted(plain)
    assert sorted(read(exported=True)) == sorted(plain | {(".net", "_.md", ""), ("_b+ %2", ".x ü.md", "x")})
    # Without an order the greatest content is there.
    assert sk.export_pages(df, str(out)) == 6
    assert {r.content for r in rd.read_pages(spark, str(out / "a")).collect()} == {"Ü"}


def test_the_export_query_leaves_no_page_out(spark, tmp_path):
    part = spark.range(30).selectExpr(
        "id AS p_partkey", "'n' AS p_name", "concat('Brand#', id % 2) AS p_brand", "'t' AS p_type", "1 AS p_size", "1.0D AS p_retailprice"
    )
    part.write.parquet(str(tmp_path / "part.parquet"))
    got = [(r.family, r.name, r.content) for r in io_queries.sink_export_pages(spark, str(tmp_path)).collect()]
    names = sorted((f, n) for f, n, _ in got)
    assert names == sorted([("brand0", "_index.md"), ("brand1", "_index.md")] + [(f"brand{i % 2}", f"P{i}.md") for i in range(30) if i % 7])
    home = {f: c for f, n, c in got if n == "_index.md"}
    assert "N28" in home["brand0"] and "N21" in home["brand1"]


def test_version_feeds_are_files_of_one_folder(spark, tmp_path):
    """A file per package and no folder for each; any name comes back."""
    rows = [(n, ["1", n]) for n in ("_a", "b/c", "d e+f", "g#1%23", "ü")] + [(None, []), ("twice", ["1"]), ("twice", ["1"])]
    df = spark.createDataFrame(rows, "nuget string, versions array<string>")
    assert sk.write_version_feeds(df, str(tmp_path / "f"), rows=2) == len(rows) - 1
    assert all(p.is_file() and p.suffix == ".json" for p in (tmp_path / "f").iterdir() if not p.name.startswith("."))
    got = rd.read_version_feed(spark, str(tmp_path / "f"), encoded=True).collect()
    want = {(n, tuple(v)) for n, v in rows[:5]} | {("__hive_default_partition__", ()), ("twice", ("1",))}
    assert {(r.nuget, tuple(r.versions)) for r in got} == want and len(got) == len(want)


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path):
    texts = {f"{i}.md": "ü\r\n" * (i % 3) for i in range(1600)}
    for name, text in texts.items():
        put(tmp_path / "f" / name, text)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4194304")
    try:
        pages = rd.read_pages(spark, str(tmp_path))
        assert pages.rdd.getNumPartitions() <= 100
        # Line ends stay as they are in the files.
        assert {r.name: r.content for r in pages.collect()} == {n: (tmp_path / "f" / n).read_bytes().decode() for n in texts}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """No name of a file is on the driver; the files are those that Spark's own reader finds, and the empty ones."""
    import pyarrow as pa

    from leafwright.sources import whole_files as wf

    odd = ["a b/x%20y.md", "a b/ü\u00a0z[1]{2}^`|#?+.md", "a b/deep/er/p.md", "p.md", "k=_v/_k=w.md", "_hidden/h.md", "a b/.h.md", "a b/q.txt", "a b/c.md._COPYING_"]
    for i, name in enumerate(odd):
        put(tmp_path / "t" / name, f"{i}\r\n")
    put(tmp_path / "t" / "a b" / "none.md", "")
    for path, glob in (("t", "*.md"), ("t/a*", "*.md"), ("t/{a,k}*", "[c-x]*.{md,txt}"), ("t/p.md", "*.md"), ("t/_hidden", "*")):
        path = str(tmp_path / path)
        plain = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        want = sorted(plain.selectExpr("string(content)", "_metadata.file_path", "_metadata.file_name").collect())
        files = wf.whole_files(spark, path, glob)
        assert sorted(files.collect()) == want and want
        assert not [f for f in files.inputFiles() if "/t/" in f]
    assert not [f for f in rd.read_pages(spark, str(tmp_path / "t")).inputFiles() if "/t/" in f]
    assert [r.content for r in rd.read_pages(spark, str(tmp_path / "t")).filter("name = 'none.md'").collect()] == [""]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        rd.read_pages(spark, str(tmp_path / "no"))
    # A folder without pages, and large folders and files, which go to Spark in several batches.
    assert rd.read_pages(spark, str(tmp_path / "t" / "k=_v"), "f").filter("name LIKE 'a%'").count() == 0
    monkeypatch.setattr(wf, "LISTED", 2)
    monkeypatch.setattr(wf, "READ", 5)
    root = pa.RecordBatch.from_pydict({"root": [f"file:{tmp_path}/t"], "below": ["a b"]})
    listed = list(wf._list(iter([root]), lambda name, folder, size: not wf.hidden(name, folder)))
    assert len(listed) > 1 and sum(b.num_rows for b in listed) == 5
    files = [b.filter(pa.compute.invert(b["folder"])) for b in listed]
    assert [b.num_rows for b in wf._read(iter(files))] == [2, 2]
    # Where Arrow has no file system, Spark reads.
    monkeypatch.setattr(wf, "_opened", lambda root: (_ for _ in ()).throw(pa.ArrowInvalid(root)))
    assert {r.name for r in rd.read_pages(spark, str(tmp_path / "t")).collect()} >= {"p.md", "_k=w.md"}


def test_attempts_that_do_not_count_are_dropped(tmp_path):
    from leafwright.sources.page_files import PageFilesWriter
    from pyspark.sql import Row

    writer = PageFilesWriter(str(tmp_path / "s"))
    first, second = (writer.write(iter([Row(folder="f", name="a.md", content="x")])) for _ in range(2))
    writer.commit([second, writer.write(iter([])), None])
    lists = list((tmp_path / "s" / "lists").iterdir())
    assert len(lists) == 1 and first.folder not in lists[0].read_text() and lists[0].read_text().endswith("\tf/a.md\n")
    writer.abort([second])
    assert not (tmp_path / "s").exists()


@pytest.mark.parametrize("size", [1, 40, 333, 10_000])
def test_a_json_map_is_read_in_ranges(spark, tmp_path, size):
    """Keys and values that reach over the ends of ranges, with every sign that could mislead."""
    odd = ['a,b', 'q"u,o"te', "\\,", "}{][", "", "ü\n\t", "\\\"", '{"x": [1, 2]}']
    data = {f"k{i},{odd[i % 8]}": {"v": odd[(i * 3 + 1) % 8] * (i % 4), "l": [[1, {"a": "],["}], []], "n": None} for i in range(120)}
    values = {k: json.dumps(v, separators=(",", ":"), ensure_ascii=False) for k, v in data.items()}
    put(tmp_path / "a.json", json.dumps(data, indent=1))
    put(tmp_path / "b.json", json.dumps(data, ensure_ascii=False))
    for name, text in (("bad", json.dumps(data)[:-1]), ("list", json.dumps([data])), ("no", "no, no"), ("two", '{"a": 1}, {"b": 2}'), ("cut", '{"a": 1, "b"}'), ("end", '{"a": 1,}')):
        put(tmp_path / f"{name}.json", text)
    put(tmp_path / "none.json", " { } ")
    put(tmp_path / "nothing.json", "")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size * 8 if size > 1 else 64))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        ranges = spark.read.option("lineSep", ",").text(str(tmp_path / "a.json")).rdd.getNumPartitions()
        assert size == 10_000 or ranges >= 4
        rows = read_json_map(spark, str(tmp_path), "struct<v: string, l: string, n: string>").collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    got = {}
    for r in rows:
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.key, r.value.v, json.loads(r.value.l)))
    want = sorted((k, v["v"], v["l"]) for k, v in data.items())
    assert len(values) == 120 and set(got) == {"a.json", "b.json"} and all(sorted(g) == want for g in got.values())


def test_status(spark, tmp_path):
    put(tmp_path / "s.json", json.dumps({"A": {"nuget": "a", "version": "1", "processed": "2024-01-02"}, "B": {"version": "2"}}))
    rows = rd.read_status(spark, str(tmp_path / "s.json")).orderBy("family").collect()
    assert [tuple(r) for r in rows] == [("A", "a", "1", date(2024, 1, 2)), ("B", None, "2", None)]
    put(tmp_path / "bad.json", "{oops")
    assert rd.read_status(spark, str(tmp_path / "bad.json")).count() == 0
    assert rd.read_status(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(FileNotFoundError):
        rd.read_status(spark, str(tmp_path / "none.json"), strict=True)
    with pytest.raises(Exception, match="damaged"):
        rd.read_status(spark, str(tmp_path / "bad.json"), strict=True).count()


def test_version_feed(spark, tmp_path):
    put(tmp_path / "Pkg.A.json", '{"versions": ["1", "2"]}')
    put(tmp_path / "b.json", "{}")
    rows = rd.read_version_feed(spark, str(tmp_path)).orderBy("nuget").collect()
    assert [tuple(r) for r in rows] == [("b", []), ("pkg.a", ["1", "2"])]


def test_search_index(spark, tmp_path):
    put(tmp_path / "words" / "en.search-data.json", json.dumps({"/a": {"data": {"h": "1", "n": {"x": [1]}}, "title": "T"}}))
    put(tmp_path / "pdf" / "en.search-data.json", json.dumps({"/a": {"data": {"h": "2"}, "title": "P"}}))
    put(tmp_path / "pdf" / "fr.search-data.json", "{damaged")
    docs = rd.read_search_index(spark, str(tmp_path), ["words", "pdf"])
    merged = merge_search(docs).collect()
    assert [(r.lang, r.page_path, r.data, r.other) for r in merged] == [("en", "/a", {"h": "2", "n": '{"x":[1]}'}, {"title": "P"})]
    sk.write_search_index(merge_search(docs), str(tmp_path / "out"))
    assert [d for d in os.listdir(tmp_path / "out") if d.startswith("lang=")] == ["lang=en"]


def test_query_rows(spark, tmp_path):
    lines = [{"keys": ["p", "q"], "date": d} for d in ("2024-01-17", "2024-01-18", "2024-02-15", "2024-02-16")] + [{}]
    put(tmp_path / "q.json", "\n".join(map(json.dumps, lines)))
    end = F.lit("2024-02-15").cast("date")
    assert rd.read_query_rows(spark, str(tmp_path), end).count() == 2  # both ends count
    assert rd.read_query_rows(spark, str(tmp_path), end, row_limit=1).count() == 1


def test_ledger_and_batches(spark, tmp_path):
    put(tmp_path / "l.json", '{"u": "2024-02-01T10:00:00Z", "v": "bad"}')
    rows = {r.url: r.processed_at for r in rd.read_ledger(spark, str(tmp_path / "l.json")).collect()}
    assert rows == {"u": datetime(2024, 2, 1, 10), "v": None}
    assert rd.read_ledger(spark, str(tmp_path / "none.json")).count() == 0
    put(tmp_path / "b.json", '{"h": [["a", "b"], ["c"]], "k": []}')
    rows = rd.read_batches(spark, str(tmp_path / "b.json")).orderBy("batch_no", "pos").collect()
    assert [tuple(r) for r in rows] == [("h", 0, 0, "a"), ("h", 0, 1, "b"), ("h", 1, 0, "c")]


def test_sitemaps_and_batch_sink(spark, tmp_path):
    body = '<?xml version="1.0"?><urlset><url><loc>https://h/x</loc></url></urlset>'
    put(tmp_path / "s" / "a.json", json.dumps({"subdomain": "h", "sitemap_url": "https://h/a.xml", "status": 200, "body": body}))
    locs = fr.locations(rd.read_sitemaps(spark, str(tmp_path / "s")))
    assert [r.loc for r in locs.collect()] == ["https://h/x"]
    batches = spark.createDataFrame([("h", 0, ["a"])], "subdomain string, batch_no long, urls array<string>")
    sk.write_batches(batches, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().urls == ["a"]


def test_artifacts(spark, tmp_path):
    put(tmp_path / "x" / "pkg" / "Fam" / "lib" / "fam.xml", "12345")
    put(tmp_path / "x" / "pkg" / "Fam" / "lib" / "Fam.dll", "1")
    rows = rd.read_artifacts(spark, str(tmp_path / "x")).collect()
    assert sorted((r.nuget, r.family, r.length) for r in rows) == [("pkg", "Fam", 1), ("pkg", "Fam", 5)]
    picked = pick_artifacts(rd.read_artifacts(spark, str(tmp_path / "x"))).first()
    assert picked.error is None and picked.xml_path.endswith("fam.xml")


def test_rule_files(tmp_path):
    put(tmp_path / "c.yml", "checks:\n  - id: a\n    description: A\n    weight: 3\n    type: required\nai_evaluation:\n  weight: 20\n")
    checks, ai = rd.read_checklist(str(tmp_path / "c.yml"))
    assert [(c.id, c.weight, c.type) for c in checks] == [("a", 3, "required")] and ai == {"weight": 20}
    put(tmp_path / "f.yml", 'apiRules:\n  - include:\n      uidRegex: ^A$\n  - exclude:\n      uidRegex: "^B\\\\.x"\n')
    assert rd.read_filter_rules(str(tmp_path / "f.yml")) == [("include", "^A$"), ("exclude", r"^B\.x")]


def test_state_metrics_keywords(spark, tmp_path):
    assert rd.read_review_state(spark, str(tmp_path / "none")).count() == 0
    state = spark.createDataFrame([("r", 1, "p", "APPROVE", 90, datetime(2024, 1, 1), None)], rd.REVIEW_STATE_SCHEMA)
    sk.write_review_state(state, str(tmp_path / "state"))
    assert rd.read_review_state(spark, str(tmp_path / "state")).first().score == 90
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        sk.write_review_state(state, str(tmp_path / "state"))
    for _ in range(2):
        sk.append_metrics(state, str(tmp_path / "metrics"))
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2
    words = spark.createDataFrame([("https://h.x/p", ["a"])], "url string, keywords array<string>")
    sk.write_keywords(words, str(tmp_path / "kw"))
    assert "subdomain=h.x" in os.listdir(tmp_path / "kw")
    updates = spark.createDataFrame([("f", "n", "1")], "family string, nuget string, version string")
    sk.write_updates(updates, str(tmp_path / "u"))
    assert [json.loads(r.value) for r in spark.read.text(str(tmp_path / "u")).collect()] == [[{"family": "f", "nuget": "n", "version": "1"}]]


def test_changed_files_and_permissive(spark, tmp_path):
    df = spark.createDataFrame([("r", 1, 0, "a.md", "added", None, 1, 0, "x")], rd.CHANGED_FILE_SCHEMA)
    df.write.json(str(tmp_path / "j"))
    assert rd.read_changed_files(spark, str(tmp_path / "j"), "json").first().content == "x"
    parsed = spark.createDataFrame([("1",), (None,)], "p string")
    good, bad = rd.permissive(parsed, "p")
    assert good.count() == 1 and bad.first().errors == 1
