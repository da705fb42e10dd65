"""From raw documents to token ids: five stages, each written and read again before the next.

STAGES holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns that they
were given. Nulls, empty and long texts, repeated rows, empty tables and further columns have the results that the operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, line_dedup, near_dup, pieces, toxicity
from .common import materialize, table

#: Executors that have run the stages before keep their memory, so the last one's workers take less of it than op5's do.
FRUGAL = {"batch_chars": 1_000_000, "chunks_kept": 150_000, "index_chars": 120_000}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more go; it learns from the labelled rows among docs that are not held out."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur in other documents go; n_chars, if there, follows.

    A copy of a whole document keeps what it shares with its original, for the next stage to judge. Documents of which nothing but white
    space is left go; those that came empty stay.
    """
    out, lost = line_dedup.drop_recurring(docs, leave_copies=True)
    out = out.where((F.size(lost) == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(lost) == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest id stays."""
    return near_dup.keep_one(docs, 80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, piece_ids, and whether the ids decode to the text."""
    model = pieces.default_model()
    encoded, ids = pieces.encode(docs.select("doc_id", "text"), model, round_trip="round_trip", **FRUGAL)
    n = F.when(F.col(ids).isNull(), F.lit(0)).otherwise(F.size(ids)).cast("long")
    return encoded.select("doc_id", n.alias("n_tokens"), F.col(ids).alias("piece_ids"), "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near duplicates", keep_one),
    ("decontamination", drop_contaminated),
    ("pieces", to_pieces),
]
#: A trained classifier and byte-pair encoding are beyond SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage-" + name.replace(" ", "-"))
    return docs
