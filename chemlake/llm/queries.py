"""The numbered queries: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemlake.llm import chat, decontaminate, divergence, embeddings, html_text, minhash, oracles, periodic_runs, pii, quality, repeats, sentence_pieces, token_counts, token_files
from chemlake.llm.workspace import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors by cosine of 0.9 or more."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans as counts and digest, and all spans."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digests(pii.find_personal_data(docs, carry=["doc_id"]))


def span_digests(found: DataFrame) -> DataFrame:
    base = F.filter("personal", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("personal", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("personal")).alias("spans"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items of which they hold at least half, in any order of passages."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    pairs = found.select("doc_id", F.explode("leaks").alias("leak"))
    return pairs.select("doc_id", "leak.item_id", "leak.n_words", "leak.n_matched", "leak.n_tiles")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that an earlier place in the corpus holds already, whatever its length."""
    return repeats.repeated_units(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from the labels outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, _table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 50k byte-level vocabulary."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of every pair of conversations that stand next to each other or share a first turn."""
    conversations = _table(spark, sf_dir, "conversations")
    return chat.format_preferences(conversations, chat.natural_pairs(conversations))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: 3-word shingles, Jaccard similarity of 85 % or more."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under the 32k model, as digests; covered: bytes from the first piece's start to the last one's end."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_digests(sentence_pieces.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")))


def piece_digests(encoded: DataFrame) -> DataFrame:
    ids = F.col("pieces.ids")
    return encoded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("pieces.decoded"), 256).alias("decoded_sha256"),
        F.coalesce(F.try_element_at("pieces.ends", F.lit(-1)) - F.try_element_at("pieces.begins", F.lit(1)), F.lit(0)).cast("long").alias("covered"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the 49k vocabulary, each with id 1 at its end, as read back from the token files."""
    folder = f"{Workspace(spark).root}/token-files"
    token_files.encode_to_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each two sources of a language diverge, and the ten terms that stand out most in each source."""
    return divergence.audit_sources(_table(spark, sf_dir, "documents"), least_docs=10, top=10)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, after the periods that the query plants in a tenth of them."""
    docs = with_planted_periods(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return run_digests(periodic_runs.find_runs(docs, least=12))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """docs with the words of each text whose id hashes to a multiple of ten repeated from some word on; texts without id stay."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g = F.floor(h / 10)
    chosen = docs.withColumns({"_g": g, "_words": F.when(h % 10 == 0, words)}).withColumn("_n", F.size("_words").cast("long"))
    placed = chosen.withColumn("_from", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
    period = F.lit(1) + F.floor((F.col("_n") - F.col("_from")) / (F.lit(3) + F.col("_g") % 8))
    measured = placed.withColumn("_p", period)
    word = lambda i: F.get("_words", F.when(i < F.col("_from"), i).otherwise(F.col("_from") + (i - F.col("_from")) % F.col("_p")).cast("int"))
    again = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1), word), " ")
    return measured.withColumn("text", F.when(F.col("_n") > 0, again).otherwise(F.col("text"))).drop("_g", "_words", "_n", "_from", "_p")


def run_digests(found: DataFrame) -> DataFrame:
    runs = F.col("runs.runs")
    longest = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.minus")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-best.minus * 1000) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("runs.collapsed"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_vectors, op2_pii, op3_decontaminate, op4_repeats, op5_quality, op6_token_counts, op7_preferences, op8_minhash, op9_sentence_pieces, op10_html_text, op11_token_files, op12_source_divergence, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    """The other queries are held against plain versions in tests/llm."""
    return {"op1_near_vectors": oracles.OP1, "op4_repeats": oracles.OP4, "op7_preferences": oracles.OP7, "op8_minhash": oracles.OP8, "op12_source_divergence": oracles.OP12, "op13_periodic_runs": oracles.OP13}
