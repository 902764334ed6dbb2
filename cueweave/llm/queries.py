"""One query an operator, over its whole table with production parameters, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cueweave.llm import importance, line_dedup, repeats, vector_codes
from cueweave.llm.common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cueweave.llm.token_count import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.token_store import store

    return store(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op3_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.bit_codes import search

    return search(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).drop("key")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.main_text import extract

    return extract(table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.matroska import features, store

    return features(store(table(spark, sf_dir, "documents")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.ngram_join import ngram_join

    return ngram_join(table(spark, sf_dir, "documents")).drop("th")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.pieces import piece_digest

    return piece_digest(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.repeats import digest, remove_repeats

    return digest(remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.vector_codes import code_digest, compress

    return code_digest(*compress(table(spark, sf_dir, "embeddings")))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cueweave.llm.importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_token_store": op2_token_store,
    "op3_bit_codes": op3_bit_codes,
    "op4_mixing": op4_mixing,
    "op5_main_text": op5_main_text,
    "op6_line_dedup": op6_line_dedup,
    "op7_matroska": op7_matroska,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_join": op9_ngram_join,
    "op10_pieces": op10_pieces,
    "op11_repeats": op11_repeats,
    "op12_vector_codes": op12_vector_codes,
    "op13_importance": op13_importance,
}

ORACLE: dict[str, str] = {"op6_line_dedup": line_dedup.SQL, "op11_repeats": repeats.SQL, "op12_vector_codes": vector_codes.SQL, "op13_importance": importance.SQL}
