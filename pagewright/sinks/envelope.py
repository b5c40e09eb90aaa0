"""Answers in the envelope of a chat model, their content fenced as JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The fields of the envelope.
SCHEMA = "model string, created_at string, message struct<role:string,content:string>, done boolean, done_reason string, total_duration bigint, load_duration bigint, prompt_eval_count bigint, prompt_eval_duration bigint, eval_count bigint, eval_duration bigint"


def write(model: str, content: Column, created: Column | None = None, fence: bool = True) -> Column:
    body = F.concat(F.lit("```json\n"), content, F.lit("\n```")) if fence else content
    at = F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'") if created is not None else F.lit("1970-01-01T00:00:00Z")
    zero = [F.lit(0).cast("bigint").alias(n) for n in ("total_duration", "load_duration", "prompt_eval_count", "prompt_eval_duration", "eval_count", "eval_duration")]
    return F.to_json(F.struct(F.lit(model).alias("model"), at.alias("created_at"), F.struct(F.lit("assistant").alias("role"), body.alias("content")).alias("message"), F.lit(True).alias("done"), F.lit("stop").alias("done_reason"), *zero))


def read(envelope: Column) -> tuple[Column, Column]:
    """(model, content), both '' for what can't be read."""
    e = F.from_json(envelope, SCHEMA)
    return F.coalesce(e["model"], F.lit("")), F.coalesce(e["message"]["content"], F.lit(""))
