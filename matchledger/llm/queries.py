"""The registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.llm import decontam, fingerprints, langid, merkle, mixing, piece_ids, prefix_trie, secrets, simhash, sql, sql_trees, tokens, toxicity, urlfilter, warc
from matchledger.llm.common import crc_mod, shared_dir, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=~crc_mod("doc_id", 5, 0))
    return toxicity.score(docs, model).select("doc_id", crc_mod("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.cluster(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    warc.write(table(spark, sf_dir, "pages"), at)
    got = warc.records(spark, at)
    refers = F.regexp_extract(warc.field(F.col("header"), "WARC-Refers-To"), "<urn:record:(-?[0-9]+)>", 1)
    return got.select(
        F.col("key").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        warc.field(F.col("header"), "WARC-Type").alias("record_type"),
        refers.cast("long").alias("refers_to"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = tuple(r.kind for r in secrets.BASE)
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [of_kind(k) for k in base]
    spans = F.col("spans")
    return secrets.scan(table(spark, sf_dir, "documents")).select("doc_id", *counts, F.sha2(secrets.joined(spans, base), 256).alias("base_sha256"), secrets.joined(spans).alias("spans"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~crc_mod("doc_id", 4, 2)))
    return langid.predict(docs, model).select("doc_id", crc_mod("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(spark, table(spark, sf_dir, "documents"))


def token_table(spark: SparkSession, docs: DataFrame, keep: int = tokens.KEEP, between: bool = True) -> DataFrame:
    """Writes the token files and reads them back; keep and between as in tokens.write()."""
    at = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex[:12]}"
    tokens.write(docs, at, public_tokenizers.path("byte_bpe_50k.json"), keep=keep, between=between)
    return tokens.read(spark, at, tokens.crc32, "ids_crc32 long").withColumnRenamed("id", "doc_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.audit(table(spark, sf_dir, "documents"), lambda f: lowered if f == "text" else F.col(f), crc_mod("doc_id", 3, 0))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    base = F.col("conv") - F.pmod("conv", F.lit(20))
    first = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    return prefix_trie.trie(*prefix_trie.rebuilt(own, base, first, 3))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    told = piece_ids.decode(piece_ids.encode(table(spark, sf_dir, "documents"), model), model, to="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return told.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_mixing": op3_mixing,
    "op4_warc": op4_warc,
    "op5_secrets": op5_secrets,
    "op6_url_filter": op6_url_filter,
    "op7_language_id": op7_language_id,
    "op8_token_ids": op8_token_ids,
    "op9_decontamination": op9_decontamination,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLE_SQL: dict[str, str] = sql.ORACLE_SQL | {"op11_merkle": sql_trees.MERKLE, "op12_prefix_trie": sql_trees.TRIE}
