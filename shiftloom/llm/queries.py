"""The queries of the operators in this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe, chunks, conversations, decontaminate, imatch, langid, licenses, lm, setsketch, simhash, suffixes, templates
from .texts import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": lambda spark, folder: bpe.encode(
        spark, table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=False
    ),
    "op2_imatch": lambda spark, folder: imatch.report(spark, table(spark, folder, "documents")),
    "op3_line_templates": lambda spark, folder: templates.report(table(spark, folder, "documents")),
    "op4_language_id": lambda spark, folder: langid.report(table(spark, folder, "documents")),
    "op5_substring_dedup": lambda spark, folder: chunks.report(table(spark, folder, "documents")),
    "op6_lm_score": lambda spark, folder: lm.report(
        spark, table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY)
    ),
    "op7_simhash": lambda spark, folder: simhash.report(table(spark, folder, "documents")),
    "op8_license_scan": lambda spark, folder: licenses.report(table(spark, folder, "documents")),
    "op9_decontamination": lambda spark, folder: decontaminate.report(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    ),
    "op10_suffix_dedup": lambda spark, folder: suffixes.report(table(spark, folder, "documents")),
    "op11_setsketch": lambda spark, folder: setsketch.report(table(spark, folder, "documents")),
    "op12_conversation_repair": lambda spark, folder: conversations.report(table(spark, folder, "conversations")),
    "op13_token_alignment": lambda spark, folder: alignment.alignments(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    ),
}

SQL: dict[str, str] = {
    "op3_line_templates": templates.SQL,
    "op9_decontamination": decontaminate.SQL,
    "op11_setsketch": setsketch.SQL,
}
