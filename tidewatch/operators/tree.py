"""Decision tree grown level by level from histograms (M2).

Features are cut into ``bins`` equal steps between their least and greatest
value.  Each level is one grouped aggregate of (node, feature, bin): rows and
attacks, summed in each task before the shuffle, so what moves is bounded by
nodes x features x bins whatever the number of rows.  A node's split is the cut
with the smallest weighted Gini impurity; ties go to the first feature in name
order and its lowest cut, so the same data give the same tree anywhere.  The tree is a
nested ``when`` in the scoring plan: no model object travels.

Rows with a null label take no part in training; a null feature goes left.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass
class Tree:
    """Nodes in heap order (children of i: 2i and 2i + 1): splits and the share of attacks in leaves."""
    splits: dict[int, tuple[str, float]] = field(default_factory=dict)
    shares: dict[int, float] = field(default_factory=dict)
    depth: int = 0

    def node(self) -> Column:
        """The leaf that a row falls into."""
        def below(i: int) -> Column:
            if i not in self.splits:
                return F.lit(i)
            feature, cut = self.splits[i]
            right = F.coalesce(F.col(feature) >= F.lit(cut), F.lit(False))
            return F.when(right, below(2 * i + 1)).otherwise(below(2 * i))
        return below(1)

    def attack_share(self) -> Column:
        leaf = self.node()
        out = F.lit(None).cast("double")
        for i, p in sorted(self.shares.items()):
            if i not in self.splits:
                out = F.when(leaf == i, F.lit(p)).otherwise(out)
        return out


def grow(df: DataFrame, features: list[str], label_col: str = "label", attack: int = 0, depth: int = 3,
         bins: int = 32, least_rows: int = 20) -> Tree:
    """Grow a tree of at most ``depth`` levels.  The driver holds each level's splits, at most 2^depth."""
    features = sorted(features)
    d = df.where(F.col(label_col).isNotNull()).select(
        *[F.col(f).cast("double").alias(f) for f in features], (F.col(label_col) == attack).cast("long").alias("_y"))
    ends = d.agg(*[g(f).alias(f"{n}_{f}") for f in features for n, g in (("lo", F.min), ("hi", F.max))]).first()
    step = {f: (ends[f"hi_{f}"] - ends[f"lo_{f}"]) / bins for f in features if ends[f"lo_{f}"] is not None}
    usable = [f for f in features if step.get(f)]
    tree = Tree(depth=depth)

    def bin_of(f: str) -> Column:
        at = F.floor((F.col(f) - F.lit(ends[f"lo_{f}"])) / F.lit(step[f]))
        return F.coalesce(F.least(at, F.lit(bins - 1)), F.lit(0)).cast("int")

    for level in range(depth):
        if not usable:
            break
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), bin_of(f).alias("bin")) for f in usable]))
        h = (d.select(tree.node().alias("node"), "_y", cells.alias("c"))
             .where(F.col("node") >= 2 ** level)  # leaves that were not split stay out
             .groupBy("node", "c.feature", "c.bin").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos")))
        run = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("node", "feature")
        h = h.select("node", "feature", "bin", F.sum("n").over(run).alias("ln"), F.sum("pos").over(run).alias("lp"),
                     F.sum("n").over(whole).alias("tn"), F.sum("pos").over(whole).alias("tp"))
        left = F.col("lp") * (F.col("ln") - F.col("lp")) / F.col("ln")
        rn, rp = F.col("tn") - F.col("ln"), F.col("tp") - F.col("lp")
        cost = left + rp * (rn - rp) / rn
        now = F.col("tp") * (F.col("tn") - F.col("tp")) / F.col("tn")
        good = (F.col("ln") >= least_rows) & (rn >= least_rows) & (cost < now)
        first = Window.partitionBy("node").orderBy("cost", "feature", "bin")
        best = (h.where(F.col("ln").isNotNull()).where(good).withColumn("cost", cost)
                .withColumn("place", F.row_number().over(first)).where("place = 1").collect())
        if not best:
            break
        for r in best:  # a cut lies on the lower border of its bin
            tree.splits[r.node] = (r.feature, float(ends[f"lo_{r.feature}"] + r.bin * step[r.feature]))
    rows = d.groupBy(tree.node().alias("node")).agg(F.avg("_y").alias("share")).collect()
    tree.shares = {r.node: float(r.share) for r in rows}
    return tree


def score(df: DataFrame, tree: Tree) -> DataFrame:
    """``df`` with leaf, attack_share and prediction_binary (0: attack), all in one projection."""
    d = df.withColumns({"leaf": tree.node(), "attack_share": tree.attack_share()})
    return d.withColumn("prediction_binary", F.when(F.col("attack_share") >= 0.5, 0).otherwise(1))
