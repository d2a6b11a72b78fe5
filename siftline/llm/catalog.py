"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftline.llm import archive, credentials, fill_middle, line_rules, line_templates, main_text, mixture, near_dupes, neighbours, quality, segmentation, toxicity, whitening
from siftline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": lambda spark, folder: segmentation.report(table(spark, folder, "documents")),
    "op2_line_templates": lambda spark, folder: line_templates.report(table(spark, folder, "documents")),
    "op3_minhash_near_dedup": lambda spark, folder: near_dupes.near_duplicates(table(spark, folder, "documents")),
    "op4_quality_classifier": lambda spark, folder: quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op5_permutation_index": lambda spark, folder: neighbours.nearest(table(spark, folder, "embeddings")),
    "op6_credential_links": lambda spark, folder: credentials.report(table(spark, folder, "documents")),
    "op7_toxicity": lambda spark, folder: toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels")),
    "op8_line_frequency_rules": lambda spark, folder: line_rules.judged(table(spark, folder, "documents")),
    "op9_capture_index": lambda spark, folder: archive.archived(table(spark, folder, "pages")),
    "op10_mixture": lambda spark, folder: mixture.decisions(table(spark, folder, "documents")),
    "op11_whitening": lambda spark, folder: whitening.report(table(spark, folder, "embeddings")),
    "op12_fill_middle": lambda spark, folder: fill_middle.report(table(spark, folder, "documents")),
    "op13_main_text": lambda spark, folder: main_text.report(table(spark, folder, "pages")),
}
SQL: dict[str, str] = {
    "op2_line_templates": line_templates.SQL,
    "op3_minhash_near_dedup": near_dupes.SQL,
    "op6_credential_links": credentials.SQL,
    "op8_line_frequency_rules": line_rules.SQL,
    "op9_capture_index": archive.SQL,
    "op10_mixture": mixture.SQL,
    "op12_fill_middle": fill_middle.SQL,
}
