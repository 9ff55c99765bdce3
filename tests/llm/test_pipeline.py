"""``corpus_pipeline.run`` from end to end over small tables: awkward rows, and none at all."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


def tables(spark, root, docs, rng_words):
    docs.write.parquet(f"{root}/documents.parquet")
    ids = [r[0] for r in docs.select("doc_id").dropna().distinct().collect()]
    labels = [(i, 1, 0) for i in ids if i % 2 == 0 and i != 600] + [(9000 + i, 0, 0) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    bench = [(1, rng_words), (2, None), (3, "")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")


@pytest.fixture()
def small(spark, corpus):
    """The awkward corpus without its longest text, with a contaminated document and ones of low quality."""
    rng = random.Random(11)
    item = " ".join("".join(rng.choice("ba ce di fo gu la me ni po ru".split()) for _ in range(3)) for _ in range(30))
    bad = [(9000 + i, " | ".join(["worthless"] * 40), "en", "src1", 1) for i in range(20)]
    extra = [(800, f"{item}", "en", "src0", 1), *bad]
    docs = corpus.filter("doc_id IS NULL OR doc_id <> 400").unionByName(spark.createDataFrame(extra, corpus.schema))
    return docs, item


def test_run_over_nulls_copies_and_contamination(spark, tmp, small):
    docs, item = small
    tables(spark, tmp, docs, item)
    out = corpus_pipeline.run(spark, tmp)
    assert out.columns == [*docs.columns, "copy"]
    rows = out.collect()
    kept = {r["doc_id"] for r in rows}
    assert kept and kept <= {r["doc_id"] for r in docs.collect()}
    assert 800 not in kept and not any(i is not None and i >= 9000 for i in kept)
    assert not {0, 200, 201} <= kept  # exact copies: one of them at most
    numbered = {}
    for r in rows:
        numbered.setdefault((r["doc_id"], r["text"]), []).append(r["copy"])
    assert all(1 in copies for copies in numbered.values())


def test_run_over_an_empty_table(spark, tmp, small):
    docs, item = small
    tables(spark, tmp, docs.limit(0), item)
    out = corpus_pipeline.run(spark, tmp)
    assert out.columns == [*docs.columns, "copy"] and out.count() == 0


def test_run_over_nothing_but_nulls(spark, tmp, small):
    docs, item = small
    nulls = docs.limit(3).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema.fields])
    tables(spark, tmp, nulls, item)
    assert corpus_pipeline.run(spark, tmp).columns == [*docs.columns, "copy"]
