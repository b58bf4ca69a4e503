import re
from collections import Counter

import corpus_pipeline
from leafwright.llm import mixing
from leafwright.llm.paragraphs import without_repeats
from pyspark.sql import functions as F

from .conftest import ODD, SF
from .test_mixing import water
from .test_packing import check
from .test_paragraphs import check as check_passages
from .test_simhash import classes, plain

SF_LABELLED = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    """Each stage against a plain version on its own input."""
    docs = spark.read.parquet(f"{SF_LABELLED}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF_LABELLED).write.parquet(str(tmp_path / str(i)))
        kept.append(spark.read.parquet(str(tmp_path / str(i))))
        assert i == 4 or kept[-1].columns == columns
    first, clean, single, once, mixed, packed = (k.collect() for k in kept)
    ids = [{r.doc_id for r in rows} for rows in (first, clean, single, once)]
    assert ids[0] > ids[1] > ids[2] == ids[3]
    # Plain insults are gone; documents that no one calls toxic stay.
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_LABELLED}/labels.parquet").collect()}
    held = [i for i in ids[0] if toxic.get(i) == 0]
    assert sum(i in ids[1] for i in held) >= 0.99 * len(held)
    insult = re.compile(r"(?i)\b(idiot|moron|stupid|scum|loser)\b")
    # The score has seen some thirty toxic documents here.
    left, all_ = (sum(len(insult.findall(r.text)) > 1 for r in rows) for rows in (clean, first))
    assert left <= 0.2 * all_
    # One document of each brute-force group of fingerprints is left.
    fps = [plain(r.text) for r in clean]
    assert sorted(r.doc_id for r in single) == sorted(set(classes(fps, [r.doc_id for r in clean])))
    before = {r.doc_id: r.text for r in single}
    marked = without_repeats(kept[2]).select("doc_id", "removed", "text").collect()
    check_passages([(r.doc_id, r.text) for r in single], marked)
    assert {r.doc_id: r.text for r in once} == {r.doc_id: r.text for r in marked}
    assert all(r.n_chars == (len(r.text) if r.text != before[r.doc_id] else len(before[r.doc_id])) for r in once)
    sizes, taken, lengths = Counter(), Counter(), {}
    for r in once:
        sizes[r.source] += len(r.text.split())
        lengths.setdefault(r.source, []).append(len(r.text.split()))
    for r in mixed:
        taken[r.source] += len(r.text.split())
    for source, target in water(sizes).items():
        # No choice of documents comes nearer from below; bit i of ``reach`` is a sum of i words.
        rounds, reach = int(target // sizes[source]), 1
        budget = round(target) - rounds * sizes[source]
        for n in lengths[source]:
            reach |= reach << n
        assert taken[source] == rounds * sizes[source] + (reach & ((1 << budget + 1) - 1)).bit_length() - 1
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3
    assert check(packed, [(r.doc_id, r.text) for r in mixed]) < 0.03


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.agg(F.sum("length")).first()[0] > 0


#: Names that operators use for columns of their own.
CLASHES = ("row", "score", "changed", "removed", "size", "source_size", "target", "copies", "key", "hash", "range", "rank", "id", "fp", "component_id", "cut", "gone", "words", "col")


def test_odd_rows(spark, odd, none):
    """Every stage takes odd rows and empty tables, and brings other columns through, whatever their names."""
    plain_columns = ["doc_id", "text", "lang", "source", "n_chars"]
    theirs = [F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASHES]
    for docs in (odd, none):
        docs = docs.select(*plain_columns, *theirs)
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF)
            rows = docs.collect()
            if i < 4:
                assert docs.columns == columns
                assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASHES)
    kept = corpus_pipeline.drop_repeated_paragraphs(spark, odd.select(*plain_columns), SF)
    assert kept.count() == len(ODD)
    near = corpus_pipeline.drop_near_copies(spark, odd.select(*plain_columns), SF)
    assert sorted((str(r.doc_id), r.text) for r in near.collect() if r.doc_id != 7) == sorted(
        [("1", None), ("4", "one"), ("6", ODD[6][1]), ("None", "no id here at all")], key=str
    )


def test_many_rows_without_id(spark):
    """Rows without an id are spread over the tasks of each stage, and none is lost."""
    rows = spark.range(10_000).select(
        F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(17).cast("long").alias("n_chars"),
    )
    mixed = corpus_pipeline.mix_sources(spark, rows, SF)
    assert mixed.count() == 10_000
    found = mixing.mix(rows, mixing.size_of(F.col("text")))
    assert found.groupBy("copies").count().count() == 1
    packed = corpus_pipeline.pack_sequences(spark, mixed, SF)
    assert packed.agg(F.sum("length"), F.max(F.col("offset") + F.col("length"))).first()[1] <= 4096
    assert packed.select("doc_tokens", "length").filter("doc_tokens <> length").count() == 0 and packed.count() == 10_000
