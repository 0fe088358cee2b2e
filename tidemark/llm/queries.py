"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat, infill, merkle, minhash, mixing, pitman_yor, quality, sharding, simhash, substrings, suffixes, winnowing
from tidemark.llm.common import documents, hex60, only, stored

#: The vocabulary file that the token queries use.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = only(docs, doc_id="doc_id", source="source", size=mixing.word_count(F.col("text")))
    mix = mixing.mixture(stored(sized, "mix-sizes"), F.col("size"))
    return mix.select("doc_id", "mix.*")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compared_with_edits(documents(spark, sf_dir))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pitman_yor.scored(documents(spark, sf_dir))
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(only(documents(spark, sf_dir), doc_id="doc_id", text="text"))
    return found.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.without_repeats(only(documents(spark, sf_dir), doc_id="doc_id", text="text"))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.repetition(only(documents(spark, sf_dir), doc_id="doc_id", text="text"))
    return judged.select("doc_id", "quality.*")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = only(
        documents(spark, sf_dir),
        doc_id="doc_id",
        size=(F.octet_length(text) + 16).cast("long"),
        text_crc32=F.crc32(text.cast("binary")),
        key=hex60(text),
        key2=hex60(F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))),
    )
    return sharding.sharded(stored(rows, "shard-sizes")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    given = only(tables, conv_id="conv_id", turn="turn", role="role", text="text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.sql(
        f"SELECT -1L AS conv_id, t AS turn, r AS role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)"
    )
    formatted = chat.rendered(chat.folded(chat.event_log(given.unionByName(probe))))
    back = chat.read_back(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), VOCABULARY)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.transformed(only(documents(spark, sf_dir), doc_id="doc_id", text="text"))
    back = infill.restored(F.col("fim.output"), F.col("fim.form"))
    return found.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), banding=minhash.Banding(size=4))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, doc_id, text = documents(spark, sf_dir), F.col("doc_id"), F.col("text")
    head = [doc_id, F.col("source"), F.col("lang"), F.col("n_chars")]
    leaf = merkle.digest_of(*head, text)
    touched = (F.crc32(doc_id.cast("string")) % 2 == 0) & F.contains(text, F.lit("\n"))
    changed = merkle.digest_of(*head, F.replace(text, F.lit("\n"), F.lit("")))
    rows = only(docs, doc_id="doc_id", source="source", leaf=leaf, tampered=F.when(touched, changed))
    found = merkle.manifest(rows)
    again = found.withColumn("given", F.coalesce("row.tampered", "row.leaf"))
    return again.select(
        "row.doc_id",
        "row.leaf",
        "subroot",
        "root",
        merkle.proof_digest().alias("proof_sha256"),
        merkle.folded(spark, "given").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_fingerprints,
        op3_lm_scoring,
        op4_substring_dedup,
        op5_suffix_array_dedup,
        op6_quality_rules,
        op7_sharding,
        op8_chat_formatting,
        op9_bpe,
        op10_simhash_near_dedup,
        op11_fill_in_middle,
        op12_minhash_near_dedup,
        op13_merkle_manifest,
    )
}
