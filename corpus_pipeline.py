"""A corpus pipeline: toxic documents go, repeated passages go, one of each near-duplicate group stays, sources are mixed,
and what is left is cut into pieces. Every stage reads what the one before it wrote.

Stages keep every column of documents, whatever the names, but for the last. An empty table stays empty. Rows with null ids,
texts or sources are rows like others; what each stage makes of them is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueweave.llm import line_dedup, mixing, ngram_join, pieces, toxicity
from cueweave.llm.common import discard, materialize, scratch, table
from cueweave.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold; the model learns from the labels of those in docs. Null, empty and wordless
    texts score 0 and stay, repeated rows score alike, and without labels nothing goes."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that later occurrences of a three-line window cover; n_chars follows the text. No row goes: a
    text all of whose lines go becomes empty, a null text stays null, rows that repeat id and text are one document."""
    left = line_dedup.dedup_lines(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id (null last) of each class of the n-gram join; rows that repeat id and text are one document. Null,
    empty and wordless texts are like no other and stay."""
    return ngram_join.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Null and empty texts, which have no words, stay once; a null source is one of
    its own, and rows that agree in id, text and source pool their copies."""
    return mixing.mixed(docs)


def cut_into_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digest of the N-best segmentations of each document; null and empty texts have one without pieces."""
    return pieces.piece_digest(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("pieces", cut_into_pieces),
]

#: A recurrent network has no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        with scratch():  # a stage's own tables go once its result is written
            result = materialize(stage(spark, docs, sf_dir), f"stage-{name}", keep=True)
        if k:
            discard(docs)
        docs = result
    return STAGES[-1][1](spark, docs, sf_dir)
