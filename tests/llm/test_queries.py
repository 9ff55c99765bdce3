"""Registered queries against their SQL, the pipeline against a brute-force version of its stages."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from kontor.llm.common import read
from kontor.llm.oracle import ORACLE
from kontor.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[key](spark, SF)
    cur = con.execute(entry.oracle_sql()[key])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    want = sorted(tuple(str(r[i]) for i in order) for r in cur.fetchall())
    assert sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect()) == want


def test_queries_and_the_pipeline_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(QUERIES) <= set(entry.queries())


def test_each_stage_equals_brute_force_on_what_the_one_before_left(spark):
    from test_decontaminate import brute
    from test_mixing import brute as copies
    from test_repeats import plain
    from test_simhash_dedup import plain_classes, plain_fingerprint

    from kontor.llm import quality

    docs = read(spark, SF, "documents")
    columns, states = docs.columns, [docs.collect()]
    labels, bench = read(spark, SF, "labels"), read(spark, SF, "benchmark")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, spark.createDataFrame(states[-1], docs.schema), SF)
        states.append(docs.collect())
        assert docs.columns == (columns if name != "mixing" else [*columns, "copy"])
    raw, good, one, cut, clean, mixed = states

    scores = {r["doc_id"]: r["score"] for r in quality.score_documents(spark.createDataFrame(raw), labels).collect()}
    assert sorted(r["doc_id"] for r in good) == sorted(r["doc_id"] for r in raw if scores[r["doc_id"]] >= 0.3)
    classes = plain_classes([plain_fingerprint(r["text"]) for r in good], [r["doc_id"] for r in good], 4)
    assert sorted(r["doc_id"] for r in one) == sorted(set(classes))
    left = dict(zip((r["doc_id"] for r in one), plain([r["text"] for r in one], 200)))
    for r in cut:
        n_bytes, gone = left[r["doc_id"]][:2]
        text = next(x["text"] for x in one if x["doc_id"] == r["doc_id"])
        assert r["text"] == text if not gone else 0 <= n_bytes - gone - len(r["text"].encode()) <= 6 * left[r["doc_id"]][2]
    bad = {x[0] for x in brute([(r["doc_id"], r["text"]) for r in cut],
                               [(r["item_id"], r["text"]) for r in bench.collect()]) if x[-1]}
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for r in cut if str(r["doc_id"]) not in bad)
    size = {}
    for r in clean:
        size[r["source"]] = size.get(r["source"], 0) + len((r["text"] or "").encode())
    root = sum(n ** 0.5 for n in size.values())
    rate = {s: n ** 0.5 / root * sum(size.values()) / n for s, n in size.items()}
    got = {}
    for r in mixed:
        got[(r["doc_id"], r["text"])] = got.get((r["doc_id"], r["text"]), 0) + 1
    assert got == dict(+copies(clean, rate))
