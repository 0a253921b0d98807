"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import covertree, decontam, langid, licences, piece, ppm, quality, repeats, resample, secrets, simhash, toxicity, vectorcode
from .common import read

PIECE_MODEL = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.round_trip(read(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op2_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.matches(read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(read(spark, sf_dir, "documents"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample.draw(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_vectorcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcode.compress(read(spark, sf_dir, "embeddings"))


def op13_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_covertree, op3_toxicity, op4_repeats, op5_simhash, op6_licences,
                            op7_decontamination, op8_secrets, op9_quality, op10_ppm, op11_resample,
                            op12_vectorcode, op13_langid)
}
#: None of these has an exact SQL form except where given here.
ORACLES: dict[str, str] = {"op11_resample": resample.ORACLE, "op12_vectorcode": vectorcode.ORACLE}
