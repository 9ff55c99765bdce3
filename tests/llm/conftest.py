import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SYLLABLES = "ba ce di fo gu la me ni po ru sha thé vor zen".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture()
def rng():
    return random.Random(5)


@pytest.fixture()
def corpus(spark, rng):
    """Documents with the awkward cases: null and empty texts, a very long one, copies, repeated
    rows, a null id, a null source and columns beyond the usual."""
    texts = [" ".join(words(rng, rng.randint(5, 120))) for _ in range(40)]
    shared = " ".join(words(rng, 60))
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, f"{texts[i]} {shared} end{i}", "en", "src0", None) for i in range(4)]
    rows += [(200, texts[0], "en", "src1", 1), (201, texts[0], None, None, 1)]
    rows += [(300, None, "en", "src0", None), (301, "", "de", "src1", 0), (302, " \n\t ", "de", "src1", 4)]
    rows += [(400, " ".join(words(rng, 30_000)), "en", "src2", 1)]
    rows += [(500, texts[7], "en", "src0", 1)] * 2 + [(None, texts[8] + " x", "en", "src0", 1)]
    rows += [(600, "stop " * 300, "en", "src0", 1), (601, "é" * 1000, "en", "src0", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def empty(corpus):
    return corpus.limit(0)


@pytest.fixture()
def extra(corpus):
    """The same with columns whose names an operator might use itself."""
    from pyspark.sql import functions as F

    names = ("score", "fp", "hash", "rid", "copy_of", "sha", "kept", "_0", "_1", "_sha0", "_kept0", "component_id", "rate")
    return corpus.withColumns({n: F.lit(f"own {n}") for n in names})
