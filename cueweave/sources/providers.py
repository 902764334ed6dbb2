"""External models as plug-ins: any callable from a batch of prompts to a batch of answers. Offline, a replay table answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueweave.sources.tables import answers

Provider = Callable[[list[str]], list[str]]


def ask(prompts: DataFrame, provider: Callable[[], Provider], prompt_col: str = "prompt") -> DataFrame:
    """Adds answer. provider() runs once a task, so that costly clients are made there."""
    schema = prompts.withColumn("answer", F.lit("")).schema

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = provider()
        for b in batches:
            yield b.assign(answer=model(b[prompt_col].tolist()) if len(b) else [])

    return prompts.mapInPandas(work, schema)


def replay(prompts: DataFrame, recorded: DataFrame, prompt_col: str = "prompt") -> DataFrame:
    """Adds answer from recorded (prompt, answer) rows; prompts that were never asked keep null."""
    return prompts.join(recorded.select(F.col("prompt").alias(prompt_col), "answer"), prompt_col, "left")


def translation_prompts(batched: DataFrame, target: str, glossary: str = "") -> DataFrame:
    """A prompt for each batch of temporal.batches."""
    listed = F.array_join(F.transform("texts", lambda t, i: F.concat((i + 1).cast("string"), F.lit(". "), t)), "\n")
    before = F.when(F.size("context") > 0, F.concat(F.lit("Context:\n"), F.array_join("context", "\n"), F.lit("\n\n"))).otherwise(F.lit(""))
    return batched.withColumn("prompt", F.concat(F.lit(f"Translate each numbered line into {target}. Answer with a JSON array of strings.\n{glossary}\n"), before, listed))


def merge_answers(cues: DataFrame, answered: DataFrame, keys: list[str], size: int = 10) -> DataFrame:
    """Cues with the answers of their batch in place of their text, where there is one and it is not empty."""
    rows = answered.select(*keys, "batch", F.posexplode(answers(F.col("answer"))).alias("_k", "_new"))
    rows = rows.select(*keys, (F.col("batch") * size + F.col("_k")).cast("int").alias("idx"), "_new")
    return cues.join(rows, [*keys, "idx"], "left").withColumn("text", F.coalesce(F.nullif("_new", F.lit("")), "text")).drop("_new")
