"""The registered queries of this subpackage: thin calls of the operators over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    alignment,
    archives,
    class_lm,
    decontaminate,
    filter_audit,
    fingerprints,
    mixing,
    pieces,
    quality,
    repeats,
    simhash_dedup,
    token_counts,
    toxicity,
)
from .common import read


def op1_token_counts(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return (token_counts.count_tokens(read(spark, sf_dir, "documents"), str(model))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))



def op2_toxicity(spark, sf_dir):
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_mixing(spark, sf_dir):
    return mixing.replicate(read(spark, sf_dir, "documents"), temper=0.5, epochs=1.0, seed="mix-1")


def op4_quality(spark, sf_dir):
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_class_lm(spark, sf_dir):
    return class_lm.score_documents(read(spark, sf_dir, "documents"))


def op6_document_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


def op7_decontamination(spark, sf_dir):
    found = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), width=13)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_simhash_dedup(spark, sf_dir):
    classes = simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), words_per_shingle=4, max_bits=4)
    return classes.select("doc_id", simhash_dedup.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op9_suffix_dedup(spark, sf_dir):
    return repeats.removal_report(read(spark, sf_dir, "documents"), depth=200)


def op10_warc(spark, sf_dir):
    return archives.archive_round_trip(read(spark, sf_dir, "pages"))


def op11_alignment(spark, sf_dir):
    a, b = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment(read(spark, sf_dir, "documents"), a, b, keep_groups=False).drop("groups")


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), part="source")


def op13_pieces(spark, sf_dir):
    model = str(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.encoding_report(read(spark, sf_dir, "documents"), model)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_toxicity, op3_mixing, op4_quality, op5_class_lm, op6_document_fingerprints, op7_decontamination,
    op8_simhash_dedup, op9_suffix_dedup, op10_warc, op11_alignment, op12_filter_audit, op13_pieces)}
