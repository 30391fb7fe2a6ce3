"""Registered queries of the training-data operators: each is a thin digest of
what its operator returns, over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpanel.llm.common import labelled, table

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.quality_rules import apply_policy, ledger
    got = apply_policy(ledger(table(spark, sf_dir, "documents")))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept", "failed", "policy")


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.langid import fit, fold, predict
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold() != 1))
    return predict(docs, model).select(
        "doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.secrets import count_of, listed, scan
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", count_of("assign").alias("n_assign"), count_of("access").alias("n_access"),
        count_of("hex").alias("n_hex"), F.sha2(listed(below=3), 256).alias("base_sha256"),
        listed().alias("spans"))


#: Scores from here on are predicted toxic.
TOXIC_FROM = 0.3


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.langid import fold
    from barpanel.llm.toxicity import MAX_TRAINING_ROWS, fit, score
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    known = labels.filter((fold(of=4) != 2) & F.col("toxic").isNotNull())
    model = fit(labelled(docs.select("doc_id", "text"), known, MAX_TRAINING_ROWS))
    scored = score(docs, model)
    return scored.select("doc_id", F.coalesce(fold(of=4) == 2, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.packing import pack
    got = pack(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                      "doc_tokens", "sequence_id", "offset")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.licenses import scan
    return scan(table(spark, sf_dir, "documents"))


#: No source is repeated more than twice as often as the least repeated one.
MIX_MAX_REPEAT = 2.0


@query
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.mixing import Target, mix
    got = mix(table(spark, sf_dir, "documents"), Target(max_repeat=MIX_MAX_REPEAT))
    return got.select("doc_id", "source", F.round("mix_weight", 9).alias("weight"),
                      F.col("mix_pass").alias("pass"), F.col("mix_block").alias("block"),
                      F.round("mix_slot", 9).alias("slot"), F.col("mix_key").alias("order_key"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.simhash import near_duplicates
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "fingerprint", "component_id")


@query
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.embed_dedup import near_duplicates
    got = near_duplicates(table(spark, sf_dir, "embeddings"))
    return got.select("vec_id", "n_links", "component_id",
                      (F.col("vec_id") == F.col("component_id")).alias("kept"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.suffix_dedup import deduplicate
    got = deduplicate(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.repair import damage, repair
    conversations = table(spark, sf_dir, "conversations")
    return repair(damage(conversations), conversations.select("conv_id"))


#: Scores from here on are predicted good.
GOOD_FROM = 0.5


@query
def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barpanel.llm.langid import fold
    from barpanel.llm.quality import MAX_TRAINING_ROWS, fit, score
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    known = labels.filter((fold(of=3) != 1) & F.col("quality").isNotNull())
    model = fit(labelled(docs.select("doc_id", "text"), known, MAX_TRAINING_ROWS))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold(of=3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
