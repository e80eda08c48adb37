"""Registered queries of the operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import cut, scratch_path
from . import chat, decontaminate, divergence, linededup, mixing, nearcopies, pages, quality, secrets, tokencounts, tokens, warc, whitening
from .oracle import ORACLE as LLM_ORACLE  # noqa: F401
from .tables import join_on, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def quality_query(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality_metrics(table(spark, sf, "documents")).select(*columns)


def mixing_query(spark: SparkSession, sf: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf, "documents"))
    return mix.documents.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def decontaminate_query(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def tokens_of(docs: DataFrame) -> DataFrame:
    """Writes the shards of some documents and reads every document back by its key."""
    import public_tokenizers

    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    found = tokens.lookup(spark, path, docs.select("doc_id").distinct(), "doc_id")
    read = tokens.read_documents(spark, path, found, "doc_id")
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def tokens_query(spark: SparkSession, sf: str) -> DataFrame:
    return tokens_of(table(spark, sf, "documents"))


def near_copies_query(spark: SparkSession, sf: str) -> DataFrame:
    return nearcopies.near_copy_classes(table(spark, sf, "documents"))


# One record in DAMAGE_EVERY of the second replica gets a flipped bit, chosen by a hash of its page's id.
DAMAGE_EVERY = 97


def _flip(data: bytes) -> bytes:
    at = len(data) // 2
    return data[:at] + bytes([data[at] ^ 1]) + data[at + 1:]


def warc_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two replicas of all pages, the second one damaged; the audit finds the damaged records."""
    first, second = scratch_path(spark, "warc"), scratch_path(spark, "replica")
    catalogue = warc.write_warc(table(spark, sf, "pages"), first)
    marked = catalogue.withColumn("hurt", F.pmod(F.xxhash64("page_id"), F.lit(DAMAGE_EVERY)) == 0)
    warc.copy_replica(marked, first, second, _flip, "hurt")
    ours, theirs = (cut(warc.leaf_hashes(catalogue, path, ranges=True)) for path in (first, second))
    found = warc.audit(warc.merkle_levels(ours), warc.merkle_levels(theirs))
    rows = join_on(catalogue.withColumnRenamed("place", "node"), ours.select("file", "node", "hash"), ["file", "node"])
    judged = join_on(rows, found, ["file", "node"], "left")
    return judged.select(
        "page_id", "length", F.lower(F.hex("hash")).alias("sha256"), F.coalesce("status", F.lit("intact")).alias("status")
    )


def pages_query(spark: SparkSession, sf: str) -> DataFrame:
    return pages.main_text(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


def lines_query(spark: SparkSession, sf: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf, "documents"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def with_control_conversation(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose texts look like the template's own marks."""
    spark = conversations.sparkSession
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def conversation_records(conversations: DataFrame) -> DataFrame:
    """One JSON record per conversation, in one of four layouts by its roles and id."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    text = [F.get(F.col("t"), i)["text"] for i in range(3)]
    named = F.transform("t", lambda x: F.struct(
        F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"),
        x["text"].alias("value"),
    ))
    plain = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))
    known = F.forall("t", lambda x: x["role"].isin("user", "assistant", "system"))
    record = (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), F.to_json(F.struct(text[0].alias("prompt"), text[1].alias("response"))))
        .when(
            roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")),
            F.to_json(F.struct(text[0].alias("instruction"), text[1].alias("input"), text[2].alias("output"))),
        )
        .when(known & (F.pmod("conv_id", F.lit(2)) == 1), F.to_json(F.struct(named.alias("conversations"))))
        .otherwise(F.to_json(F.struct(plain.alias("messages"))))
    )
    return grouped.select("conv_id", record.alias("record"))


def chat_query(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations through records of several layouts, formatted, and read back from the formatted texts."""
    records = conversation_records(with_control_conversation(table(spark, sf, "conversations")))
    turns = chat.canonical_turns(records)
    unread = F.raise_error(F.concat(F.lit("no turns read from conversation "), F.col("conv_id").cast("string")))
    turns = turns.withColumn("turns", F.coalesce("turns", unread))
    formatted = chat.format_turns(turns).select("conv_id", "formatted", "mask")
    path = scratch_path(spark, "chat")
    formatted.write.parquet(path)
    read = chat.read_turns(spark.read.schema(formatted.schema).parquet(path))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def secrets_query(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "cut")


def whitening_query(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(table(spark, sf, "embeddings"))


COUNTING_TOKENIZER = "byte_bpe_50k.json"


def token_counts_query(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tokencounts.token_counts(table(spark, sf, "documents"), public_tokenizers.path(COUNTING_TOKENIZER))


def divergence_query(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_quality": quality_query,
    "op2_mixing": mixing_query,
    "op3_warc": warc_query,
    "op4_decontaminate": decontaminate_query,
    "op5_pages": pages_query,
    "op6_lines": lines_query,
    "op7_tokens": tokens_query,
    "op8_chat": chat_query,
    "op9_secrets": secrets_query,
    "op10_near_copies": near_copies_query,
    "op11_whitening": whitening_query,
    "op12_token_counts": token_counts_query,
    "op13_divergence": divergence_query,
}
