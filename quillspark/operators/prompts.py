"""Prompt and chat rows for language-model scoring / fine-tuning sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import render_prompt

# Assistant answers for True / False labels.
LABEL_WORDS = {True: "Ja", False: "Nein"}


def to_chat(pairs: DataFrame, template: str, a: str = "text0", b: str = "text1", label_col: str | None = "label",
            out: str = "messages") -> DataFrame:
    """Pair -> array<struct<role, content>>: the user turn holds the
    rendered prompt; with a label, an assistant turn says Ja / Nein."""
    user = F.struct(F.lit("user").alias("role"), render_prompt(template, a, b).alias("content"))
    if label_col is None:
        return pairs.withColumn(out, F.array(user))
    ans = F.when(F.col(label_col).cast("boolean"), F.lit(LABEL_WORDS[True])).otherwise(F.lit(LABEL_WORDS[False]))
    assistant = F.struct(F.lit("assistant").alias("role"), ans.alias("content"))
    return pairs.withColumn(out, F.array(user, assistant))
