"""Queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers

from visitlens.llm import (
    alignment,
    exact_dedup,
    hard_negatives,
    html_text,
    kneser_ney,
    language,
    license_notices,
    line_dedup,
    mixing,
    near_dups,
    pieces,
    quality_rules,
    warc,
)
from visitlens.llm.common import table


def op1_quality_rules(spark, folder):
    return quality_rules.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_near_dups(spark, folder):
    return near_dups.digest(table(spark, folder, "documents"))


def op3_kneser_ney(spark, folder):
    return kneser_ney.digest(table(spark, folder, "documents"))


def op4_exact_dedup(spark, folder):
    return exact_dedup.digest_rows(table(spark, folder, "documents"))


def op5_pieces(spark, folder, model_file=public_tokenizers.path("piece_bpe_32k.model")):
    return pieces.digest(table(spark, folder, "documents"), model_file)


def op6_html_text(spark, folder):
    return html_text.digest(table(spark, folder, "pages"))


def op7_language(spark, folder):
    return language.digest(table(spark, folder, "documents"))


def op8_line_dedup(spark, folder):
    return line_dedup.digest(table(spark, folder, "documents"))


def op9_warc(spark, folder):
    return warc.digest(table(spark, folder, "pages"))


def op10_mixing(spark, folder):
    return mixing.digest(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_license_notices(spark, folder):
    return license_notices.digest(table(spark, folder, "documents"))


def op12_alignment(spark, folder, byte_file=public_tokenizers.path("byte_bpe_50k.json"), piece_file=public_tokenizers.path("piece_bpe_32k.model")):
    return alignment.digest(table(spark, folder, "documents"), byte_file, piece_file)


def op13_hard_negatives(spark, folder):
    return hard_negatives.digest(table(spark, folder, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_near_dups,
        op3_kneser_ney,
        op4_exact_dedup,
        op5_pieces,
        op6_html_text,
        op7_language,
        op8_line_dedup,
        op9_warc,
        op10_mixing,
        op11_license_notices,
        op12_alignment,
        op13_hard_negatives,
    )
}

ORACLE = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op9_warc": warc.SQL,
    "op10_mixing": mixing.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
