"""The registered queries: each applies one operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm.common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.token_files import token_dataset

    return token_dataset(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), "words", 1)


def op1_quality_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.quality import judge

    return judge(table(spark, sf_dir, "documents"))


def op2_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.subspace import vector_duplicates

    return vector_duplicates(table(spark, sf_dir, "embeddings"))


def op3_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_guess_cost_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.secret_scan import scan_documents

    return scan_documents(table(spark, sf_dir, "documents"))


def op6_boosted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.urls import judge_urls

    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    return judge_urls(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op7_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), "spaced")


def op8_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.mixing import plan_mix

    return plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.pii import scan_documents

    return scan_documents(table(spark, sf_dir, "documents"))


def op10_odd_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), 2)


def op11_agenda_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.pieces import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "library_agrees")


def op12_stream_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.collocations import phrase_scores, top_phrases

    return top_phrases(phrase_scores(table(spark, sf_dir, "documents"), 100, 100), 2000).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_trie_pair_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from graphloom.llm.variants import count_words, variant_forms

    return variant_forms(count_words(table(spark, sf_dir, "documents"), 7, 2, 31), 10)


QUERIES = {f.__name__: f for f in (op1_quality_sketch, op2_subspace_join, op3_lpt_shards, op4_token_files,
                                 op5_guess_cost_secrets, op6_boosted_urls, op7_nnls_packing, op8_water_filling, op9_boosted_pii,
                                 op10_odd_sketch_dedup, op11_agenda_pieces, op12_stream_collocations, op13_trie_pair_variants)}
