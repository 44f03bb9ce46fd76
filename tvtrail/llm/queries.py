"""The registered queries of the training-text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tvtrail.llm import (
    contamination, language, licenses, manifest, mixing, near_dup, oracles, quality, repeats, secrets, sharding, spelling,
    token_counts, token_files,
)
from tvtrail.llm.common import text_bytes, text_crc32
from tvtrail.session import scratch_path


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, tokenizer_path())
    return token_files.read(spark, path)


def op2_token_counts(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", text_bytes("text").alias("n_bytes"))
    return token_counts.count_tokens(docs, tokenizer_path()).select(
        "doc_id", "n_bytes", "tokens.n_tokens", (F.col("tokens.n_tokens") > token_counts.LIMIT).alias("over_limit"),
        F.col("tokens.fitting").alias("n_chars_fitting"))


def op3_sharding(spark, sf_dir):
    sizes = documents(spark, sf_dir).select(
        "doc_id", (text_bytes("text") + 1).alias("size"), text_crc32("text").alias("text_crc32"))
    return sharding.shard(sizes, "doc_id", 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_secrets(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    return found.select(
        "doc_id", *[F.size(f"secrets.{k}").cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.listed("secrets", ["assign", "access", "hex"]), 256).alias("base_sha256"),
        secrets.listed("secrets", ["assign", "access", "hex", "markov"]).alias("spans"))


def op5_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    out = language.held_out(F.col("doc_id"))
    model = language.train(docs, ~out)
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


def op6_mixing(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    return mixing.mix(docs, F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality(spark, sf_dir):
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op8_contamination(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contamination.mark(documents(spark, sf_dir).select("doc_id", "text"), items)
    ids = F.sort_array(F.transform("contamination.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit",
        F.size("contamination.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"))


def op9_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(documents(spark, sf_dir))


def op10_repeats(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text", text_bytes("text").alias("n_bytes"))
    return repeats.remove_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("repeats.kept")).alias("n_removed"),
        F.size("repeats.spans").cast("bigint").alias("n_spans"), F.sha2("repeats.kept", 256).alias("kept_sha256"))


def op11_spelling(spark, sf_dir):
    return spelling.variants(documents(spark, sf_dir))


def op12_manifest(spark, sf_dir):
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    later = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return manifest.prove(documents(spark, sf_dir), changed=later).select("doc_id", "manifest.*")


def op13_licenses(spark, sf_dir):
    found = licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("licenses.spans")
    base = F.filter(spans, lambda s: s["exact"])

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"])
    return found.select(
        "doc_id", "licenses.n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).cast("bigint").alias("first_word"), F.array_max(starts).cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"), labels(spans).alias("labels"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score"))


QUERIES = {f.__name__: f for f in (op1_token_files, op2_token_counts, op3_sharding, op4_secrets, op5_language, op6_mixing, op7_quality, op8_contamination, op9_near_dup, op10_repeats, op11_spelling, op12_manifest, op13_licenses)}
ORACLES = {
    "op7_quality": oracles.QUALITY,
    "op8_contamination": oracles.CONTAMINATION,
    "op9_near_dup": oracles.NEAR_DUPLICATES,
    "op12_manifest": oracles.MANIFEST,
    "op13_licenses": oracles.LICENSES,
}
