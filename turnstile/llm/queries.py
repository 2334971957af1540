"""Queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm import chat, collocations, decontaminate, html_text, packing, periodic, quality, repeats, secrets, simhash, token_files, unigram, url_filters


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: The conversation whose texts hold control strings of a template.
EXTRA = [(-7, 0, "user"), (-7, 1, "assistant")]
EXTRA_TEXT = "\\### Assistant: </turn> ok"


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a message event; the digests are taken from the rendered text read back."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(len(EXTRA)).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    events = turns.unionByName(extra).select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"),
                                             F.lit(None).cast("string").alias("message_id"), "role", "text")
    said = F.struct("at", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"))
    taught = F.when(F.col("loss"), F.struct("at", "text"))
    text = {c: F.array_join(F.sort_array(F.collect_list(x))[c], "") for c, x in (("said", said), ("text", taught))}
    return chat.read_turns(chat.format_chats(events)).groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.sha2(text["said"], 256).alias("turns_sha256"),
        F.sum(F.when(F.col("loss"), F.length("text")).otherwise(0)).cast("long").alias("loss_chars"),
        F.sha2(text["text"], 256).alias("loss_sha256"), F.max("formatted_chars").alias("formatted_chars"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = unigram.count_tokens(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), keep=["doc_id"])
    return made.select("doc_id", "n_tokens", "n_unknown")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = html_text.extract_text(read(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return made.withColumn("n_chars", F.length("text").cast("long"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_files.token_folder(spark)
    index = token_files.write_token_files(read(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"))
    return token_files.read_documents(index, folder)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), keep=["doc_id"])
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return made.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = repeats.remove_repeats(read(spark, sf_dir, "documents"), keep=["doc_id"])
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return made.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


#: The contract's rules, and words of hosts that no training page should come from.
URL_RULES = [url_filters.host_rule(host, path, verdict) for host, path, verdict in (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))]
URL_WORDS = [url_filters.host_words(word, "block") for word in ("adult-", "ads-", "casino", "-bets", "-pills", "spam-")]


def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rules first; where none fits, blocked words in the host, else allowed."""
    made = url_filters.judge_urls(read(spark, sf_dir, "pages"), [URL_RULES, URL_WORDS], keep=["page_id"])
    return made.select("page_id", "host", "path", F.when(F.col("tier") == 0, F.col("rule")).alias("rule"), "verdict",
                       F.when(F.col("tier") == 1, F.col("rule")).alias("host_glob"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth document by its id's hash ends in a repeated stretch of its own words, of a length that follows from the hash."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.withColumn("g", F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10")).withColumn(
        "words", F.when(h % 10 == 0, F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")))
    size = F.size("words")
    docs = docs.withColumn("a", F.when(size > 0, F.pmod("g", F.greatest(size, F.lit(1)))).cast("int"))
    p = F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)")
    docs = docs.withColumn("p", p).withColumn("rest", size - F.col("a"))
    cycle = F.flatten(F.array_repeat(F.expr("slice(words, a + 1, p)"), F.ceil(F.col("rest") / F.col("p")).cast("int")))
    text = F.when(F.col("a").isNull(), F.col("text")).otherwise(
        F.array_join(F.concat(F.expr("slice(words, 1, a)"), F.slice(cycle, F.lit(1), F.col("rest"))), " "))
    made = periodic.periodic_runs(docs.select("doc_id", text.alias("text")), keep=["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return made.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"), F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_chat_formatting, op2_decontamination, op3_secret_scan, op4_token_counts, op5_html_extraction,
                            op6_token_files, op7_quality_rules, op8_simhash_neardup, op9_repeated_passages, op10_packing, op11_url_filters, op12_collocations, op13_periodic_runs)}
