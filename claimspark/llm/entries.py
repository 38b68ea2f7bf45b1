"""Queries that apply each operator to its whole table, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimspark.llm import fim, linededup, merkle, minhash, packing, pieces, pii, quality, sharding, spelling, sql, tokenstore, warc, wordtable
from claimspark.llm.common import table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.stored_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.repeated_lines(table(spark, sf_dir, "documents"), percent=80)
    return found.select("doc_id", "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1, window=2048)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.byte_shards(table(spark, sf_dir, "documents"), shards=8)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("level")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.restored(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    shas = (F.sha2(F.encode(c, "UTF-8"), 256).alias(f"{c}_sha256") for c in ("output", "restored"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *shas)


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = wordtable.decode(wordtable.encode(table(spark, sf_dir, "documents"), path), path)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.vocabulary(spelling.runs(table(spark, sf_dir, "documents"), least=6, drop=199), least=6, often=5)
    return spelling.variant_groups(words, ratio=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash,
        op2_sentencepiece,
        op3_token_store,
        op4_line_dedup,
        op5_warc,
        op6_packing,
        op7_fingerprints,
        op8_sharding,
        op9_pii,
        op10_quality_rules,
        op11_fill_in_middle,
        op12_byte_bpe,
        op13_spelling,
    )
}

ORACLES = {
    "op1_minhash": sql.NEAR_DUPLICATES,
    "op4_line_dedup": sql.LINE_DEDUP,
    "op10_quality_rules": sql.QUALITY,
    "op11_fill_in_middle": sql.FILL_IN_MIDDLE,
    "op13_spelling": sql.SPELLING,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
