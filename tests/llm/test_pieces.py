import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from kontor.llm import pieces as PC

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = [*" ▁\n\t\r0aé漢🙂thein<>s/|%#-.,\xa0", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "the ", "  ", "   ", "ing"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def fuzzed(n, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_fuzzed_texts_equal_the_library(library):
    texts = fuzzed(4000)
    for t, ids, decoded in zip(texts, *PC.Pieces(MODEL).encode_all(texts)):
        wanted = library.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == wanted and decoded == library.decode(wanted), repr(t)


def test_whole_texts_where_pieces_cross_marks(library):
    known = PC.Pieces(MODEL)
    known.crossing = True
    texts = fuzzed(300)
    assert known.encode_all(texts) == PC.Pieces(MODEL).encode_all(texts)


def test_a_full_table_starts_anew(monkeypatch):
    batches = [fuzzed(50, seed) for seed in range(20)]
    plain = PC.Pieces(MODEL)
    wanted = [plain.encode_all(texts) for texts in batches]
    monkeypatch.setattr(PC, "TABLE", 20_000)
    known = PC.Pieces(MODEL)
    for texts, w in zip(batches, wanted):
        assert known.encode_all(texts) == w
        assert known.size < 20_000 + 50 * 40 * 400
    assert len(known.ids) < len(plain.ids)


def test_report_equals_the_library(spark, corpus, library):
    got = PC.encoding_report(corpus, MODEL).collect()
    rows = corpus.collect()
    assert len(got) == len(rows)
    wanted = []
    for r in rows:
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        wanted.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)


def test_empty_table_and_further_columns(empty, extra):
    from pyspark.sql import functions as F

    assert PC.encoded(empty, MODEL).count() == 0
    clash = extra.withColumns({"ids": F.lit(1), "decoded": F.lit(2), "_encoded0": F.lit(3), "a.b": F.lit(4)})
    out = PC.encoded(clash, MODEL)
    assert out.columns == [*extra.columns, "_encoded0", "a.b", "ids", "decoded"]
    assert out.filter("text = decoded").count() == extra.filter("text <> ''").count() + extra.filter("text = ''").count()
