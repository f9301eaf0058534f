"""The operators on the driver tables, with the columns their contracts name."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packshot.llm import (
    best_fit_packing,
    chat_format,
    decontamination,
    exact_dedup,
    fill_in_middle,
    jaccard_join,
    lm_scoring,
    quality_classifier,
    quality_rules,
    secret_scan,
    substring_dedup,
    target_sampling,
    token_output,
)
from packshot.llm.sql import SQL
from packshot.runtime import application_folder, materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_best_fit_packing(spark, sf_dir):
    return best_fit_packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op1_lm_scoring(spark, sf_dir):
    return lm_scoring.scored(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.repeat_digests(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark, sf_dir):
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_classifier(spark, sf_dir):
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat_format(spark, sf_dir):
    text = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.read_back(materialise(chat_format.format_turns(rows)))


def op10_secret_scan(spark, sf_dir):
    return secret_scan.secret_spans(table(spark, sf_dir, "documents"))


def op9_token_output(spark, sf_dir):
    path = f"{application_folder(spark)}/token-files-{uuid.uuid4().hex}"
    files = token_output.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file())
    return token_output.read_token_files(files)


def op11_fill_in_middle(spark, sf_dir):
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents")))


def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op13_target_sampling(spark, sf_dir):
    return target_sampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op9_token_output": op9_token_output,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_decontamination": op6_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_chat_format": op8_chat_format,
    "op10_secret_scan": op10_secret_scan,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_target_sampling": op13_target_sampling,
}
