"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.llm import (conversations, fingerprint, host_quality, html_text, langid, mixing, ngram_join, packing,
                         sentence_spans, sharding, sql, warc, wavelet, whitening)
from pitstop.llm.scratch import with_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(fn):
        QUERIES[name] = with_package(fn)
        if oracle:
            ORACLE_SQL[name] = oracle
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id long, text string, lang string, source string, n_chars long")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages", "page_id long, url string, html string")


@register("op1_mix_sources", sql.MIX)
def op1_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


@register("op6_shard_documents")
def op6_shard_documents(spark, sf_dir):
    return sharding.write_and_read(documents(spark, sf_dir))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op8_pack_documents")
def op8_pack_documents(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


@register("op9_host_quality", sql.HOST_QUALITY)
def op9_host_quality(spark, sf_dir):
    return host_quality.judge(documents(spark, sf_dir))


@register("op4_language_id")
def op4_language_id(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@register("op7_ngram_join")
def op7_ngram_join(spark, sf_dir):
    return ngram_join.join(documents(spark, sf_dir)).members.drop("key", "label")


@register("op10_sentence_spans")
def op10_sentence_spans(spark, sf_dir):
    left = sentence_spans.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), within=True)
    return left.select("row.doc_id", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
                       "n_sentences", "n_removed")


@register("op5_warc_archives", sql.WARC)
def op5_warc_archives(spark, sf_dir):
    return warc.round_trip(pages(spark, sf_dir)).drop("url")


@register("op2_html_text")
def op2_html_text(spark, sf_dir):
    return html_text.extract(pages(spark, sf_dir))


@register("op3_fingerprints")
def op3_fingerprints(spark, sf_dir):
    return fingerprint.fingerprints(documents(spark, sf_dir))


@register("op12_token_files")
def op12_token_files(spark, sf_dir):
    return wavelet.encode_and_read(documents(spark, sf_dir), tokenizer_path())


@register("op11_repair_conversations", sql.REPAIR)
def op11_repair_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations", "conv_id long, turn long, role string, text string")
    return conversations.repair(conversations.damage(rows))


@register("op13_whiten_embeddings")
def op13_whiten_embeddings(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
