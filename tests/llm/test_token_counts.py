import random

import public_tokenizers
import pytest
import sentencepiece

from kontor.llm import token_counts as TC

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_equal_the_library(spark, corpus, library):
    for r in TC.count_tokens(corpus, MODEL).collect():
        text = r["text"] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 4096)


def test_fuzzed_texts_equal_the_library(library):
    rng = random.Random(2)
    letters = [*" ▁\n\t\r0aé漢🙂thein<>s/|%#-.,", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "the ", "  ", "‍"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert TC.count_text(text, MODEL) == len(library.encode(text)), repr(text)


def test_the_shortcut_table_holds_single_tokens_only(library):
    proved = TC.tables(MODEL)[1].proved
    assert len(proved) > 30000 and set(proved.values()) == {1}


def test_the_table_of_merged_parts_stays_bounded(monkeypatch):
    monkeypatch.setattr(TC, "REMEMBERED", 50)
    counts = TC.PartCounts(TC.tables(MODEL)[1].encoder, {})
    for i in range(500):
        counts[f"▁qx{i}zz"]
    assert len(counts) <= 52


def test_empty_table_and_further_columns(empty, extra):
    assert TC.count_tokens(empty, MODEL).count() == 0
    out = TC.count_tokens(extra, MODEL)
    assert out.columns == [*extra.columns, "n_bytes", "n_tokens", "over_limit"] and out.count() == extra.count()
