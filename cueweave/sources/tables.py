"""Markdown tables, JSON artefacts and model answers as DataFrames."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def markdown_rows(lines: DataFrame) -> DataFrame:
    """Cells of table rows from (file, line, s): file, line, section (the header above), cells. Rules and heads are left out."""
    w = Window.partitionBy("file").orderBy("line")
    rows = lines.withColumn("section", F.last(F.when(F.col("s").startswith("#"), F.trim(F.regexp_replace("s", "^#+", ""))), ignorenulls=True).over(w))
    rule = F.col("s").rlike("^\\s*\\|[\\s:|-]+\\|\\s*$")
    rows = rows.withColumn("_rule", rule).withColumn("_head", F.coalesce(F.lead("_rule").over(w), F.lit(False)))
    cells = F.transform(F.split(F.regexp_replace(F.trim("s"), "^\\||\\|$", ""), "(?<!\\\\)\\|"), lambda c: F.replace(F.trim(c), F.lit("\\|"), F.lit("|")))
    return rows.filter(F.trim("s").startswith("|") & ~F.col("_rule") & ~F.col("_head")).select("file", "line", "section", cells.alias("cells"))


def json_strings(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst) of a JSON object of strings, empty values left out."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("src", "dst")).filter("dst != ''")


def asr_segments(raw: DataFrame) -> DataFrame:
    """Recogniser output (ep, value: JSON) as segments, whichever of transcription, segments or result holds them, and
    whether times are seconds, millisecond offsets or texts."""
    one = "array<struct<start:string,end:string,text:string,no_speech_prob:double,avg_logprob:double,compression_ratio:double,offsets:struct<from:string,to:string>>>"
    found = F.coalesce(*[F.from_json(F.get_json_object("value", f"$.{k}"), one) for k in ("transcription", "segments", "result")])
    rows = raw.select("ep", F.posexplode(found).alias("seg_idx", "s"))
    seconds = lambda c: F.round(c.try_cast("double") * 1000).cast("long")
    return rows.select(
        "ep", "seg_idx", F.coalesce(F.col("s.offsets.from").try_cast("long"), seconds(F.col("s.start"))).alias("start_ms"), F.coalesce(F.col("s.offsets.to").try_cast("long"), seconds(F.col("s.end"))).alias("end_ms"),
        F.trim("s.text").alias("text"), F.coalesce("s.no_speech_prob", F.lit(-1.0)).alias("no_speech_prob"), "s.avg_logprob", "s.compression_ratio",
    )


def parse_answer(answer: str | None) -> list[str] | None:
    """The list of strings in a model's answer: fences go, a trailing comma or a cut end is mended; null if there is none."""
    if not answer:
        return None
    body = re.sub(r"```(?:json)?", "", answer)
    start = body.find("[")
    if start < 0:
        return None
    stop = body.rfind("]")
    tries = [body[start : stop + 1]] if stop > start else []
    cut = body[start:]
    tries += [re.sub(r",\s*([\]}])", r"\1", tries[0])] if tries else []
    ends = [i for i, ch in enumerate(cut) if ch in '"}'][:-8:-1]  # a cut answer ends within its last few strings
    tries += [cut[: i + 1] + "]" for i in ends]
    for t in tries:
        try:
            got = json.loads(t)
        except ValueError:
            continue
        if isinstance(got, list):
            return [x if isinstance(x, str) else str(next((x[k] for k in ("translation", "text", "zh") if k in x), "")) if isinstance(x, dict) else str(x) for x in got]
    return None


@F.pandas_udf(ArrayType(StringType()))
def answers(s: pd.Series) -> pd.Series:
    return s.map(parse_answer)


def violations(df: DataFrame, required: dict[str, str] | None = None, enums: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows that break a contract, one row a broken rule: the row as JSON, column and rule. required maps columns to types
    that their text must have ('string' takes all)."""
    rules: list[Column] = []
    for c, kind in (required or {}).items():
        bad = F.col(c).isNull() if kind == "string" else F.col(c).cast("string").try_cast(kind).isNull()
        rules.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.lit("required" if kind == "string" else f"type {kind}").alias("rule"))))
    for c, values in (enums or {}).items():
        rules.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(values), F.struct(F.lit(c).alias("column"), F.lit("enum").alias("rule"))))
    return df.select(F.to_json(F.struct("*")).alias("row"), F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("v")).select("row", "v.*")


KINDS = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        return not isinstance(value, bool) and (isinstance(value, int) or isinstance(value, float) and (kind == "number" or value.is_integer()))
    return isinstance(value, KINDS[kind])


def broken_rules(value: object, schema: dict, root: dict, path: str = "$") -> list[tuple[str, str]]:
    """(path, rule) of all rules of a JSON schema that a value breaks: type (one or several), enum, required, properties,
    additionalProperties, items, and $ref within the schema."""
    while "$ref" in schema:
        target: dict = root
        for part in schema["$ref"].removeprefix("#/").split("/"):
            target = target[part]
        schema = target
    kinds = schema.get("type", [])
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [(path, "type")]
    out = [(path, "enum")] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        known, more = schema.get("properties", {}), schema.get("additionalProperties", True)
        out += [(f"{path}.{k}", "required") for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += broken_rules(v, known[k], root, f"{path}.{k}")
            elif more is False:
                out.append((f"{path}.{k}", "additional"))
            elif isinstance(more, dict):
                out += broken_rules(v, more, root, f"{path}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += broken_rules(v, schema["items"], root, f"{path}[{i}]")
    return out


def schema_violations(df: DataFrame, json_col: str, schema: dict) -> DataFrame:
    """Rows of df with path and rule, one row for each rule of a JSON schema that their JSON text breaks; text that is no JSON
    breaks the rule 'json' at '$', and so does null."""

    @F.pandas_udf("array<struct<path:string,rule:string>>")
    def check(texts: pd.Series) -> pd.Series:
        def one(s: str | None) -> list[dict]:
            try:
                value = json.loads(s or "")
            except ValueError:
                return [{"path": "$", "rule": "json"}]
            return [{"path": p, "rule": r} for p, r in broken_rules(value, schema, schema)]

        return texts.map(one)

    return df.withColumn("_v", F.explode(check(F.coalesce(json_col, F.lit(""))))).select("*", "_v.path", "_v.rule").drop("_v")
