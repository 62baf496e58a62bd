"""Training-set operators and model training.

* device split: named devices are the test set (leakage-free by device);
* class down-sampling to an attack:normal ratio with a *deterministic*,
  seeded hash threshold on the flow fingerprint (``sampleBy`` depends on
  partitioning and is not reproducible after a task retry);
* random forest training with ``pyspark.ml`` (seed 42).
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from tidewatch.schema import ATTACK_LABEL, NORMAL_LABEL


def device_split(df: DataFrame, test_devices: list[str], device_col: str = "device_name"):
    is_test = F.col(device_col).isin(list(test_devices))
    return df.filter(~is_test), df.filter(is_test)


def hash_unit(seed: int, key) -> "F.Column":
    """Uniform [0, 1) from SHA-256 of ``seed:key`` (first 32 bits)."""
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key) if isinstance(key, str) else key), 256)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def class_downsample(df: DataFrame, ratio: float = 2.0, seed: int = 42, label_col: str = "label",
                     key: str = "row_hash") -> DataFrame:
    """Keep every row of the scarcer side and a seeded share of the other so
    that attack:normal is about ``ratio``:1.  Class counts (two numbers) are
    computed first; the share becomes a literal in the filter."""
    r = df.agg(F.count_if(F.col(label_col) == ATTACK_LABEL).alias("a"),
               F.count_if(F.col(label_col) == NORMAL_LABEL).alias("n")).first()
    a, n = int(r["a"]), int(r["n"])
    keep_attack, keep_normal = 1.0, 1.0
    if n > 0 and a > ratio * n:
        keep_attack = ratio * n / a
    elif a > 0 and n > a / ratio:
        keep_normal = a / (ratio * n)
    u = hash_unit(seed, key)
    lab = F.col(label_col)
    return df.filter(((lab == ATTACK_LABEL) & (u < F.lit(keep_attack)))
                     | ((lab == NORMAL_LABEL) & (u < F.lit(keep_normal))))


def train_random_forest(train: DataFrame, feature_cols: list[str], label_col: str = "label",
                        seed: int = 42, num_trees: int = 20, max_depth: int = 5):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=feature_cols, outputCol="_features", handleInvalid="keep")
    rf = RandomForestClassifier(featuresCol="_features", labelCol="_label", seed=seed,
                                numTrees=num_trees, maxDepth=max_depth)
    data = train.withColumn("_label", F.col(label_col).cast("double"))
    return Pipeline(stages=[va, rf]).fit(data)


def model_card(feature_cols: list[str], test_devices: list[str], ratio: float, seed: int,
               metrics: DataFrame) -> DataFrame:
    """One-row card: fixed model facts plus the metric columns of ``metrics``
    (a one-row frame), and the whole card as JSON text."""
    facts = [F.lit(json.dumps(feature_cols)).alias("feature_cols"),
             F.lit(ATTACK_LABEL).alias("attack_label"), F.lit(NORMAL_LABEL).alias("normal_label"),
             F.lit("is_attack").alias("target"),
             F.lit(", ".join(test_devices)).alias("test_devices"),
             F.lit(f"{ratio:.2f}:1 attack:normal").alias("train_ratio"), F.lit(seed).alias("seed")]
    card = metrics.select(*facts, *metrics.columns)
    return card.withColumn("card_json", F.to_json(F.struct(*card.columns)))


def class_ratio(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Attack and normal counts and the attack:normal ratio."""
    c = df.agg(F.count_if(F.col(label_col) == ATTACK_LABEL).alias("attack_rows"),
               F.count_if(F.col(label_col) == NORMAL_LABEL).alias("normal_rows"))
    return c.withColumn("attack_to_normal",
                        F.try_divide(F.col("attack_rows").cast("double"), F.col("normal_rows").cast("double")))


def combine_metrics(frames: list[DataFrame]) -> DataFrame:
    """Merge one-row metric frames into one row without a join: unpivot each
    to (metric, value), union, and fold back with one aggregate."""
    names, longs = [], []
    for f in frames:
        names += f.columns
        longs.append(f.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in f.columns
        ])).alias("m")).select("m.*"))
    u = longs[0]
    for x in longs[1:]:
        u = u.unionByName(x)
    return u.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])
