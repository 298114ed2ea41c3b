"""From raw documents to token ids: five stages, each one of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.llm import langid, linededup, mixing, sentencepiece, simhash
from quillrank.llm.shared import Scratch, documents

#: Tokens of the mixture per token that comes in.
BUDGET_SHARE = 1.0
#: Characters whose words are packed together: fewer than the encoder's own choice, as the workers of the stages before
#: keep some memory.
SHARE_CHARS = 4_000_000

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined. Those without a text or a letter go; ``lang`` of
    the others becomes the predicted language."""
    model = langid.train(docs)
    answer = langid.predict(model, F.col("text"))
    told = docs.select(F.struct("*").alias("row"), answer.alias("answer"))
    kept = told.where(F.col("answer.lang") != langid.UNDETERMINED)
    return kept.select([
        F.col("answer.lang").alias(name) if name == "lang" else F.col("row")[name].alias(name)
        for name in docs.columns
    ])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines go, ``n_chars`` follows; a document that only had such lines stays, empty."""
    kept = linededup.drop_frequent_lines(docs)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select([
        changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns
    ])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: texts are linked whose SimHash
    fingerprints of three-word shingles differ in two bits or fewer."""
    return simhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents as often as the budgets of their leaves take them. The budget is
    all tokens that come in, so what a leaf has above its weight goes and what it lacks is made up."""
    return mixing.mix(docs, budget_share=BUDGET_SHARE)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)`` of every document of the mixture."""
    encoded = sentencepiece.encode(docs, share_chars=SHARE_CHARS)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(sentencepiece.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

# Trained scores, XXH64 and a best-path search are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again by the next."""
    scratch, docs = Scratch(spark), documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.table(name, stage(spark, docs, sf_dir))
    return docs
