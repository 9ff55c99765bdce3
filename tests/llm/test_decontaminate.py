import hashlib
import re

import pytest

from kontor.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, width=13):
    windows = {}
    for i, text in items:
        w = words(text)
        for j in range(max(len(w) - width + 1, 1) if w else 0):
            windows.setdefault(tuple(w[j:j + width]), set()).add(i)
    out = []
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                found = windows.get(tuple(w[j:j + n]))
                if found is not None:
                    hit.update(range(j, j + n))
                    named |= found - {None}
        ids = ",".join(sorted(map(str, named)))
        out.append((str(doc_id), len(w), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.fixture()
def bench(spark, corpus):
    text = {r["doc_id"]: r["text"] for r in corpus.collect()}
    items = [(1, text[3]), (2, text[3]), (10, "  ".join(words(text[5])[2:9]).upper()), (11, None), (12, " .. "),
             (None, text[9]), (13, "one two three"), (14, text[400][5000:5400]), (15, "stop stop")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [D.BLOCK, 40])
def test_report_equals_brute_force(corpus, bench, block):
    got = D.report(corpus, bench, block=block).collect()
    rows = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                  for r in got)
    want = brute([(r["doc_id"], r["text"]) for r in corpus.collect()],
                 [(r["item_id"], r["text"]) for r in bench.collect()])
    assert rows == want and sum(r[-1] for r in want) >= 4


def test_contaminated_documents_go_and_all_others_stay(corpus, extra, bench):
    bad = {r["doc_id"] for r in D.report(corpus, bench).filter("contaminated").collect()}
    left = D.without_contaminated(extra, bench)
    assert left.columns == extra.columns
    assert sorted(map(str, left.select("doc_id", "text").collect())) == sorted(
        str(r) for r in corpus.select("doc_id", "text").collect() if r["doc_id"] not in bad)


def test_spans_are_cut_and_the_rest_is_untouched(spark, bench):
    docs = spark.createDataFrame([(1, " x One, two three; y"), (2, "One two, four"), (3, None), (4, "")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in D.without_spans(docs, bench).collect()}
    assert got == {1: " x y", 2: "One two, four", 3: None, 4: ""}


def test_empty_tables(corpus, empty, bench):
    assert D.report(empty, bench).count() == 0
    assert D.report(corpus, bench.limit(0)).filter("n_hit > 0 or contaminated").count() == 0


def test_native_plan(corpus, bench):
    plan = D.report(corpus, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_template_of_every_item_is_broadcast_once_and_long_words_make_more_blocks(spark, corpus):
    """A sentence that 3,000 items share, which very many documents have, and words of 40,000 letters."""
    template = " ".join(f"template{i}" for i in range(13))
    items = [(i, f"{template} answer{i} of{i} item{i}") for i in range(3000)] + [
        (5000 + i, chr(97 + i) * 40_000 + " end") for i in range(8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, template if i % 3 else f"x {template} answer{i} y") for i in range(30)] + [
        (100, "a" * 40_000 + " end"), (101, "b" * 40_000 + " no"), (102, None)]
    windows = D.windows_of(bench)
    assert D.anchored(windows).filter("anchor like 'template%'").select("name").distinct().count() == (
        D.anchored(windows).filter("anchor like 'template%'").count())
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs, items)
    for limit in (D.BLOCK_BYTES, 4 << 20):
        got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
                     for r in D.report(table, bench, block_bytes=limit).collect())
        assert got == want
    assert {r[0]: r[3] for r in want}["1"] == 3000


def test_native_plan_of_the_scan(corpus, bench):
    plan = D.hits(corpus, D.windows_of(bench))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
