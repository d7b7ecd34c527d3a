"""The corpus pipeline: quality, near copies, benchmark leaks, personal data, pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chemlake.llm import decontaminate, minhash, pii, quality, sentence_pieces
from chemlake.llm.arrays import unused_name
from chemlake.llm.queries import piece_digests
from chemlake.llm.workspace import Workspace, drop_since, opened


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier holds to be good; labels outside the held-out fold train it.

    Null and empty texts are scored as texts without words; documents without id are scored, but train nothing.  Very
    long texts are read whole.  Rows of one id, and equal texts, are scored alike, and a score of just 0.3 is kept.  An
    empty table stays empty.  Columns of any name are kept as they are.
    """
    # under other names, so that columns of docs called like the results stay
    renamed = docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns})
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("doc_id", "in_doc_id")
    scored = quality.score_quality(renamed, labels, doc_id="in_doc_id", text="in_text")
    return scored.where("predicted = 1").select(*[F.col(f"in_{c}").alias(c) for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies (five-word shingles, similarity 0.8).

    Null and empty texts have no near copies and stay, and so do documents without id.  Very long texts are compared by
    all their shingles; a similarity of just 0.8 counts.  Rows that share an id stay or go together.  An empty
    table stays empty.  Columns of any name are kept as they are.
    """
    dropped = minhash.near_duplicates(docs, shingle=5, percent=80).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than half of every benchmark item.

    Null and empty texts hold none and stay.  Very long texts are matched whole; of runs of equal length the first are
    marked; just half of an item is a leak.  Repeated rows stay or go together.  An empty table stays empty, and an
    empty benchmark drops nothing.  Columns of any name are kept as they are.
    """
    name = unused_name(docs, "leaks")
    found = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), out=name)
    return found.where(F.size(name) == 0).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text.

    Null texts stay null, empty ones empty.  Very long texts are masked whole; of overlapping spans the first names the
    kind.  Repeated rows are masked alike.  An empty table stays empty.  Columns of any name are kept as they are.
    """
    masked = pii.mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts and digests of the documents that are left, by doc_id; other columns end here.

    Null and empty texts have no pieces.  Very long texts are encoded whole; of pairs of equal rank the leftmost is
    merged.  A repeated row gives its row again, one without id keeps its null.  An empty table stays empty.
    """
    return piece_digests(sentence_pieces.encode_pieces(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [
    ("quality classifier", reject_low_quality),
    ("MinHash near-dedup", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("PII", mask_personal_data),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: The classifier, the sketches and the pieces are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage but the last is written and read back, and then what it wrote on its way goes."""
    work, docs = Workspace(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        mark = opened()
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = work.save(docs, f"stage{i}")
            drop_since(mark, work)
            if i:
                work.drop(f"stage{i - 1}")
    return docs
