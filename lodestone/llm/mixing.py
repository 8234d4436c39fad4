"""Mixing sources to target shares of a token budget (problem 8).

Method: cube sampling. A source of T tokens that owes W tokens is used floor(W / T) times as a whole; for the rest every
document gets the inclusion probability (W mod T) / T. The flight phase moves these probabilities along the null space
of two constraints, token total and document total, until each is 0 or 1. It runs on blocks of documents in parallel;
every block leaves at most two undecided documents, which form the blocks of the next round, until one small landing
problem per source remains.

Defined cases: documents of other sources, and of none, count for the budget but are never used; a document of 0 tokens
may be used and adds nothing; a target source without documents reports 0; ``max_uses`` or shares that are null count
as 0; repeated target rows of a source are added up; repeated ``doc_id`` are documents of their own; empty tables give
an empty mixture.
"""

from __future__ import annotations

import itertools
import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.encode import token_counts
from lodestone.session import materialize

BLOCK = 4096
MAX_TARGETS = 10_000
SEED = 20240103


def flight(tokens: list[int], probs: list[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight phase: all 0 or 1 but for at most two, with both totals unchanged."""
    p = list(probs)
    active: list[int] = []
    for k in range(len(p)):
        if 0.0 < p[k] < 1.0:
            active.append(k)
        while len(active) > 2 or (len(active) == 2 and tokens[active[0]] == tokens[active[1]]):
            use = active[:3]
            t = [tokens[i] for i in use]
            if t[0] == t[1]:
                u = [1.0, -1.0, 0.0][: len(use)]
            else:
                u = [float(t[1] - t[2]), float(t[2] - t[0]), float(t[0] - t[1])]
            up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(use, u) if d)
            down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(use, u) if d)
            step = up if rng.random() * (up + down) < down else -down
            for i, d in zip(use, u):
                p[i] += step * d
                if p[i] < 1e-9:
                    p[i] = 0.0
                elif p[i] > 1 - 1e-9:
                    p[i] = 1.0
            active = [i for i in active if 0.0 < p[i] < 1.0]
    return p


def landing(tokens: list[int], probs: list[float]) -> list[float]:
    """Decide the at most two documents left so that the token total, then the document total, is met best.

    Where a long document was left, up to four others then change sides if that brings the token total closer.
    """
    p = list(probs)
    left = [k for k, x in enumerate(p) if 0.0 < x < 1.0]
    goal, count = sum(tokens[k] * p[k] for k in left), sum(p[k] for k in left)
    options = itertools.product((0.0, 1.0), repeat=len(left))
    best = min(options, key=lambda o: (abs(sum(tokens[k] * x for k, x in zip(left, o)) - goal), abs(sum(o) - count), o))
    for k, x in zip(left, best):
        p[k] = x
    gap = goal - sum(tokens[k] * p[k] for k in left)
    for _ in range(4):
        k = min(range(len(p)), key=lambda i: abs(gap - (tokens[i] if p[i] == 0 else -tokens[i])), default=None)
        change = 0 if k is None else tokens[k] if p[k] == 0 else -tokens[k]
        if abs(gap - change) >= abs(gap):
            break
        p[k] = 1.0 - p[k]
        gap -= change
    return p


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: tokens and documents available, tokens owed, whole uses and the fraction of one more use."""
    if targets.limit(MAX_TARGETS + 1).count() > MAX_TARGETS:
        raise ValueError("too many target sources")
    z = F.lit(0.0)
    goal = targets.where("source is not null").groupBy("source").agg(
        F.sum(F.coalesce(F.col("target_share").cast("double"), z)).alias("target_share"),
        F.max(F.coalesce(F.col("max_uses").cast("bigint"), F.lit(0))).alias("max_uses"),
        F.max(F.coalesce(F.col("budget_fraction").cast("double"), z)).alias("budget_fraction"),
    )
    held = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    total = held.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all_tokens"))
    p = goal.join(held, "source", "left").crossJoin(F.broadcast(total)).withColumn("tokens", F.coalesce("tokens", F.lit(0))).withColumn("docs", F.coalesce("docs", F.lit(0)))
    p = p.withColumn("owed", F.col("target_share") * F.col("budget_fraction") * F.col("all_tokens"))
    ratio = F.when(F.col("tokens") > 0, F.col("owed") / F.col("tokens")).otherwise(z)
    p = p.withColumn("whole", F.least(F.floor(ratio), F.col("max_uses")))
    return p.withColumn("part", F.when(F.col("whole") < F.col("max_uses"), ratio - F.col("whole")).otherwise(z))


def _decide(last: bool):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # Large documents first, so that what is left to the landing is small.
        pdf = pdf.sort_values(["n_tokens", "doc_id", "row_no"], ascending=[False, True, True])
        rng = random.Random(f"{SEED}|{key[0]}|{key[1]}")
        t = pdf.n_tokens.tolist()
        p = flight(t, pdf.p.tolist(), rng)
        return pdf.assign(p=landing(t, p) if last else p)

    return run


def balanced(docs: DataFrame) -> DataFrame:
    """``row_no, doc_id, source, n_tokens, p`` with p decided to 0 or 1, from documents with inclusion probabilities ``p``."""
    cols, schema = ["row_no", "doc_id", "source", "n_tokens", "p"], "row_no bigint, doc_id bigint, source string, n_tokens bigint, p double"
    open_, done = docs.select(*cols), None
    for level in range(8):
        n = open_.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        last = n <= BLOCK
        blocks = max(1, -(-n // BLOCK))
        keyed = open_.withColumn("block", F.pmod(F.xxhash64("doc_id", "n_tokens", F.lit(level)), F.lit(blocks)) if not last else F.lit(0).cast("bigint"))
        moved = materialize(keyed.groupBy("source", "block").applyInPandas(_decide(last), schema + ", block bigint").select(*cols), f"p8-flight-{level}")
        settled = moved.where("p = 0 or p = 1")
        done = settled if done is None else done.unionByName(settled)
        if last:
            return done
        open_ = moved.where("p > 0 and p < 1")
    raise RuntimeError("the flight phase did not end")


def sized(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """``row_no, doc_id, source, n_tokens`` of every document, written once; ``row_no`` tells rows of one ``doc_id`` apart."""
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text")
    return materialize(token_counts(picked, "text", ("doc_id", "source"), vocab_path).withColumn("row_no", F.monotonically_increasing_id()), "p8-sizes")


def mix(docs: DataFrame, targets: DataFrame, vocab_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mixture ``doc_id, source, n_tokens, uses`` and the plan it follows."""
    sizes = sized(docs, vocab_path)
    p = materialize(plan(sizes, targets), "p8-plan")
    rows = sizes.join(F.broadcast(p.select("source", "whole", "part")), "source")
    extra = balanced(rows.where("part > 0").select("row_no", "doc_id", "source", "n_tokens", F.col("part").alias("p")))
    uses = rows.where("whole > 0").select("row_no", "doc_id", "source", "n_tokens", F.col("whole").alias("uses")).unionByName(
        extra.where("p = 1").select("row_no", "doc_id", "source", "n_tokens", F.lit(1).cast("bigint").alias("uses"))
    )
    return uses.groupBy("row_no", "doc_id", "source", "n_tokens").agg(F.sum("uses").alias("uses")).drop("row_no"), p


def report(docs: DataFrame, targets: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """Per target source the target share, the tokens owed and got, the actual share and whether it stays short.

    A source stays short if the mixture uses each of its documents as often as allowed and still lacks tokens.
    """
    mixture, p = mix(docs, targets, vocab_path)
    got = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("uses")).alias("got_tokens"), F.sum("uses").alias("got_docs"))
    r = p.join(got, "source", "left").na.fill(0, ["got_tokens", "got_docs"])
    total = r.agg(F.sum("got_tokens").alias("mixture_tokens"))
    short = (F.col("got_docs") == F.col("docs") * F.col("max_uses")) & (F.col("got_tokens") < F.col("owed"))
    return r.crossJoin(F.broadcast(total)).select(
        "source", "target_share", F.col("tokens").alias("tokens_available"), "max_uses", F.round("owed", 3).alias("owed_tokens"), "got_tokens", "got_docs",
        F.when(F.col("mixture_tokens") > 0, F.round(F.col("got_tokens") / F.col("mixture_tokens"), 6)).alias("actual_share"), short.alias("short"),
    )
