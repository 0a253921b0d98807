"""Corpus pipeline: toxicity, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame, which ``run`` writes as Parquet and rereads for the
next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderdesk.llm import decontam, piece, queries, secrets, simhash, toxicity
from orderdesk.llm.common import free_name, materialise, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go (the model learns from the labelled rows of its own input).

    Null and empty texts get a score too (that of a text without windows), so
    they stay unless the model calls an empty text toxic; repeated rows are
    scored alike and stay or go together; without labels or documents nothing
    goes. A text takes time in proportion to its length.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs, "_toxicity")
    return toxicity.score(docs, model, score).where(F.col(score) < 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits).

    The smallest doc_id of a group stays, of repeated rows one; null and empty
    texts have fingerprint zero and are one group with others of it; a null
    doc_id goes where its group has another. No documents give none.
    """
    return simhash.survivors(docs, shingle=3, distance=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Null and empty texts contain none and stay; repeated rows stay or go
    together; an empty benchmark removes nothing. Long texts are searched whole.
    """
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Values that look live are blanked; every document stays.

    A null text stays null, an empty one empty; repeated rows are blanked
    alike; no documents give none.
    """
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each remaining document.

    A null text counts as empty (no token); repeated rows give a row each; no
    documents give no rows.
    """
    return piece.round_trip(docs, queries.tokenizer_path(queries.PIECE_MODEL))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_copies), ("decontamination", drop_leaks),
          ("secrets", redact_secrets), ("tokens", tokens)]
#: Learned scores, hashes of shingles and pieces have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
