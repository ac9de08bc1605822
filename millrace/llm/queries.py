"""The registered queries of this package: one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import oracles
from millrace.llm.align import alignments, byte_fallback, with_links
from millrace.llm.chat import chat_report, format_chat
from millrace.llm.cotrain import quality_scores
from millrace.llm.decontaminate import contamination
from millrace.llm.lm import Settings as LmSettings
from millrace.llm.lm import score_report
from millrace.llm.mixing import mix_plan
from millrace.llm.neardup import near_duplicates
from millrace.llm.packing import packed_pieces
from millrace.llm.quality import quality_report
from millrace.llm.repair import repair_report
from millrace.llm.tokens import token_report
from millrace.llm.toxicity import Settings, held_out, learning_rows, train, with_score
from millrace.llm.warc import arc_archives, convert_arc, read_warc, with_revisits, write_warc
from millrace.session import scratch_dir, written
from workloads.registry import query, table


@query("op1_decontaminate", oracles.DECONTAMINATE)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, settings = table(spark, sf_dir, "documents"), Settings()
    model = train(learning_rows(docs, table(spark, sf_dir, "labels")), settings)
    scored = with_score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= settings.threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", predicted)


@query("op4_mix_sources", oracles.MIX_SOURCES)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_lm_scores")
def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_report(table(spark, sf_dir, "documents"), settings=LmSettings(order=3))


@query("op6_arc_to_warc", oracles.ARC_TO_WARC)
def op6_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = written(arc_archives(table(spark, sf_dir, "pages")), "arc")
    path = scratch_dir(spark, "warc")
    write_warc(with_revisits(convert_arc(archives)), path)
    return read_warc(spark, path).select(
        F.col("page").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_page").cast("long").alias("refers_to"),
    )


@query("op7_near_duplicates")
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op9_chat_windows", oracles.CHAT)
def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = spark.createDataFrame(
        [(-7, i, role, "\\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))], turns.schema
    )
    return chat_report(written(format_chat(turns.unionByName(marks)), "chat-windows"))


@query("op10_quality_rules", oracles.QUALITY_RULES)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality_report(table(spark, sf_dir, "documents"))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return report.select("doc_id", *columns, "base_failed", "kept")


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    aligned = alignments(table(spark, sf_dir, "documents"), *paths)
    # The digest of a text's groups is all this report keeps of them.
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    width = len(byte_fallback(paths[1]).pieces)
    linked = with_links(aligned.withColumn("groups_sha256", digest).drop("groups"), width)
    return linked.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_repair_conversations")
def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows are damaged by a hash of their conversation and turn, then repaired."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    named = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in turns.columns}
    damage = F.crc32(F.concat(named["conv_id"], F.lit(":"), named["turn"]).cast("binary")) % 20
    text = F.when(damage == 1, "").when(damage == 2, F.regexp_replace(named["text"], "[.!?]", "")).otherwise(named["text"])
    rows = turns.where(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(named["role"]).alias("role"),
        text.alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    report = repair_report(rows).withColumnRenamed("conv_id", "repaired")
    every = turns.select("conv_id").distinct()
    joined = every.join(report, F.col("conv_id").eqNullSafe(F.col("repaired")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(n), F.lit(0).cast("long")).alias(n) for n in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


@query("op13_pack_sequences")
def op13_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = packed_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")
