"""Prompts, supervised token rows and padded batches as expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.text import strip, text
from lodestone.serving import STUB

# Texts and marks that models were trained with (fixed values): the system turn, the headings of the blocks below, the
# label that loss ignores, the answer of a server without a model.
SYSTEM = "You are a helpful assistant. Answer the user's instruction accurately and concisely. If context is provided, base your answer on it."
IGNORED = -100


def user_message(instruction: Column, context: Column) -> Column:
    i, c = strip(text(instruction)), strip(text(context))
    return F.when(c != "", F.concat(i, F.lit("\n\nContext:\n"), c)).otherwise(i)


def plain_prompt(instruction: Column, context: Column) -> Column:
    i, c = strip(text(instruction)), strip(text(context))
    middle = F.when(c != "", F.concat(F.lit("### Context:\n"), c, F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("### Instruction:\n"), i, F.lit("\n\n"), middle, F.lit("### Response:\n"))


def chat_messages(instruction: Column, context: Column, system: str | None = SYSTEM) -> Column:
    """Turns for a tokenizer that has a chat template."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    turns = [turn("system", F.lit(system))] if system else []
    return F.array(*turns, turn("user", user_message(instruction, context)))


def training_example(instruction: Column, context: Column, response: Column, eos: str = "") -> Column:
    return F.concat(plain_prompt(instruction, context), strip(text(response)), F.lit(eos))


def supervised(prompt_ids: Column, answer_ids: Column, max_length: int) -> tuple[Column, Column]:
    """Ids and labels of prompt plus answer; prompt labels are ignored; of longer rows the last ``max_length`` stay."""
    ids = F.concat(prompt_ids, answer_ids)
    labels = F.concat(F.array_repeat(F.lit(IGNORED), F.size(prompt_ids)), answer_ids)
    cut = lambda x: F.slice(x, F.greatest(F.size(x) - max_length + 1, F.lit(1)), F.lit(max_length))
    return cut(ids), cut(labels)


def encoded(df: DataFrame, load: Callable[[], Callable[[list[str]], list[list[int]]]], columns: dict[str, str]) -> DataFrame:
    """``df`` with token ids: ``columns`` names the new column of each text column.

    Any tokenizer: ``load`` runs once a worker and returns a function from texts to lists of ids. Null texts have no ids.
    """
    extra = ", ".join(f"`{c}` array<int>" for c in columns.values())

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for pdf in frames:
            yield pdf.assign(**{new: encode(pdf[old].fillna("").tolist()) for old, new in columns.items()})

    return df.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", " + extra)


def supervised_count(labels: Column) -> Column:
    return F.size(F.filter(labels, lambda x: x != IGNORED))


def padded(df: DataFrame, batch: str, pad_id: int = 0, multiple: int = 8) -> DataFrame:
    """``input_ids, labels, attention_mask`` padded to the longest row of the batch, rounded up."""
    n = F.size("input_ids")
    longest = F.max(n).over(Window.partitionBy(batch))
    to = (F.ceil(longest / multiple) * multiple).cast("int")
    return df.withColumn("_to", to).select(
        *[c for c in df.columns if c not in ("input_ids", "labels")],
        F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("_to") - n)).alias("input_ids"),
        F.concat("labels", F.array_repeat(F.lit(IGNORED), F.col("_to") - n)).alias("labels"),
        F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.col("_to") - n)).alias("attention_mask"),
    )


def stub_prediction(prompt: Column) -> Column:
    """What a server without a model answers."""
    return F.concat(F.lit(STUB), F.substring(text(prompt), 1, 200))


def finish_reason(generated: Column, max_new_tokens: Column) -> Column:
    return F.when(generated >= max_new_tokens, "length").otherwise("stop")
