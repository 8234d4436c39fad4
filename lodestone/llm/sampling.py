"""A sample that follows target category shares (problem 4).

Method: iterative proportional fitting rakes the weights of the cells (category x context present x response length
band) to the category targets and to the corpus' own shares of the two other margins; rows get the exponential key
-ln(u) / weight, with u hashed from the row's id, and the smallest keys of each category win; quotas are then repaired
to the minimums, and what cannot be met is reported: a category of which every row was drawn and that stays below its
target all the same.

No row leaves its task to be ranked: a histogram of the keys finds the bin in which a category's quota ends, all lower
bins are taken whole and only that bin is ranked. So a category may hold any share of the rows.

Defined cases: a category's spellings count together, with or without an entity label; rows of no or another category
count for the sample's size but are never drawn; a category without rows is reported with 0; null minimums and shares
count as 0; ties of keys are broken by ``_idx``; rows repeated with the same ``_idx`` are rows of their own; the
cells are a fixed number per target category, so their table is bounded by the targets (at most 10,000, checked).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.categories import base_key
from lodestone.llm.ledger import letters
from lodestone.session import materialize

MAX_TARGETS = 10_000
BINS = 1 << 16
SEED = 17
BANDS = (60, 200, 400)


def _targets(targets: DataFrame) -> pd.DataFrame:
    """Targets on the driver, one row per category (bounded and checked)."""
    rows = targets.where("category is not null").select("category", letters(F.col("category")).alias("key"), F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("share"), F.coalesce(F.col("min_rows").cast("bigint"), F.lit(0)).alias("min_rows"), F.coalesce(F.col("sample_fraction").cast("double"), F.lit(0.0)).alias("fraction")).limit(MAX_TARGETS + 1).toPandas()
    if len(rows) > MAX_TARGETS:
        raise ValueError("too many target categories")
    return rows.groupby("key", sort=True).agg(category=("category", "min"), share=("share", "sum"), min_rows=("min_rows", "max"), fraction=("fraction", "max")).reset_index()


def celled(df: DataFrame) -> DataFrame:
    """``idx, key, cell`` for every row; a cell is context present or not times the response's length band."""
    band = F.lit(0)
    n = F.length(F.coalesce("response", F.lit("")))
    for b in BANDS:
        band = band + (n >= b).cast("int")
    has = F.coalesce(F.col("context"), F.lit("")).rlike(r"\S").cast("int")
    return df.select(F.col("_idx").alias("idx"), F.coalesce(base_key(F.col("category")), F.lit("")).alias("key"), (has * (len(BANDS) + 1) + band).alias("cell"))


def rake(counts: np.ndarray, goals: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Expected draws per (category, cell) whose category sums are ``goals``, raked to the corpus' cell shares.

    A cell never yields more than its rows; what a full cell cannot give goes to the other cells of its category.
    """
    draws = counts * np.divide(goals, counts.sum(1), out=np.zeros_like(goals), where=counts.sum(1) > 0)[:, None]
    if not draws.sum():
        return draws
    contexts = counts.reshape(len(counts), 2, -1).sum((0, 2)) / counts.sum()
    bands = counts.reshape(len(counts), 2, -1).sum((0, 1)) / counts.sum()
    for _ in range(rounds):
        cube = draws.reshape(len(counts), 2, -1)
        for margin, want, axis in ((cube.sum((0, 2)), contexts, 1), (cube.sum((0, 1)), bands, 2)):
            have = margin / margin.sum()
            f = np.divide(want, have, out=np.ones_like(want), where=have > 0)
            cube = cube * f.reshape([-1 if a == axis else 1 for a in range(3)])
        draws = cube.reshape(counts.shape)
        for _ in range(counts.shape[1]):
            gap = goals - draws.sum(1)
            draws = np.minimum(draws * np.divide(goals, draws.sum(1), out=np.ones_like(goals), where=draws.sum(1) > 0)[:, None], counts)
            if np.abs(gap).max() < 1e-6:
                break
    return draws


def design(df: DataFrame, targets: DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Per category: rows, wanted rows, quota. Per (key, cell): the raked weight. Both bounded by the targets."""
    t = _targets(targets)
    total = df.count()
    have = celled(df).where(F.col("key").isin([str(k) for k in t.key])).groupBy("key", "cell").count().toPandas()
    cells = 2 * (len(BANDS) + 1)
    counts = np.zeros((len(t), cells))
    at = {k: i for i, k in enumerate(t.key)}
    for key, cell, n in have.itertuples(index=False, name=None):
        counts[at[key], cell] = n
    size = (t.fraction.max() if len(t) else 0.0) * total
    t["sample_size"], t["rows"] = size, counts.sum(1).astype("int64") if len(t) else []
    t["wanted"] = t.share * size
    goals = np.minimum(np.maximum(t.wanted, t.min_rows), t.rows).to_numpy(float)
    t["quota"] = np.minimum(np.maximum(np.round(goals), np.minimum(t.min_rows, t.rows)), t.rows).astype("int64")
    draws = rake(counts, goals) if len(t) else counts
    rate = np.divide(draws, counts, out=np.zeros_like(draws), where=counts > 0)
    w = pd.DataFrame([(k, c, float(max(rate[i, c], 1e-9))) for k, i in at.items() for c in range(cells)], columns=["key", "cell", "weight"])
    return t, w


def sample(df: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The drawn rows ``idx, category`` and the report per category."""
    spark = df.sparkSession
    t, w = design(df, targets)
    quotas = spark.createDataFrame(t[["key", "category", "quota"]], "key string, category string, quota bigint")
    weights = spark.createDataFrame(w, "key string, cell int, weight double")
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "idx"), 11).cast("double") + 0.5) / float(1 << 53)
    rows = celled(df).join(F.broadcast(weights), ["key", "cell"]).withColumn("expo", -F.log(u) / F.col("weight"))
    # Weights are inclusion rates; a rate r puts the cut near -ln(1 - r) / r, so the keys spread over all bins.
    rows = rows.withColumn("bin", F.floor(F.col("expo") / (1.0 + F.col("expo")) * BINS).cast("int")).select("idx", "key", "expo", "bin")
    up_to = Window.partitionBy("key").orderBy("bin")
    bins = rows.groupBy("key", "bin").count().withColumn("upto", F.sum("count").over(up_to)).join(F.broadcast(quotas), "key")
    edge = bins.where("upto >= quota").groupBy("key").agg(F.min("bin").alias("edge"), F.min_by(F.col("quota") - F.col("upto") + F.col("count"), "bin").alias("rest"))
    marked = rows.join(F.broadcast(edge), "key").join(F.broadcast(quotas), "key")
    below = marked.where("bin < edge").select("idx", "category")
    place = F.row_number().over(Window.partitionBy("key").orderBy("expo", "idx"))
    at_edge = marked.where("bin = edge").withColumn("place", place).where("place <= rest").select("idx", "category")
    # Written, so that the report is one of rows really drawn whichever of its columns are asked for.
    drawn = materialize(below.unionByName(at_edge), "p4-drawn")
    got = drawn.groupBy("category").agg(F.count(F.lit(1)).alias("drawn"))
    facts = spark.createDataFrame(t[["category", "share", "min_rows", "rows", "wanted", "sample_size"]], "category string, target_share double, min_rows bigint, rows bigint, wanted double, sample_size double")
    r = facts.join(got, "category", "left").na.fill(0, ["drawn"]).withColumn("exact", F.col("wanted"))
    r = r.select(
        "category", "target_share", "min_rows", "rows", F.round("wanted", 6).alias("wanted"), "drawn", F.round(F.col("drawn") - F.col("wanted"), 6).alias("gap"),
        # The draw took every row there is and still stays below the target.
        ((F.col("drawn") < F.col("exact")) & (F.col("drawn") == F.col("rows"))).alias("unmet"), (F.col("drawn") < F.col("min_rows")).alias("below_minimum"),
    )
    return drawn, r
