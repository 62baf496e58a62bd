"""Flow classification plan: parse -> dedup -> prepare -> score -> decode.

The same function serves batch frames and streaming frames: every step is a
DataFrame transformation, dedup switches to its watermark form when the input
is streaming, and the statistics are literals baked into the plan.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch import fixtures
from tidewatch.functions.parse import payload_hash
from tidewatch.operators.dedup import dedup_by_key, first_copies, in_files
from tidewatch.operators.fit import PrepStats, fit_stats, prepare
from tidewatch.operators.parse import split_rejects, tag_rejects
from tidewatch.operators.score import apply_prediction, score_linear

# Fixed coefficients of the fixture scorer (a two-class logistic model over
# the prepared fixture features; class 1 = Normal).
FIXTURE_MODEL = {
    "weights": {"f_value": 1.5, "f_k": 0.02},
    "centers": {"f_value": 3.0, "f_k": 50.0},
    "intercept": 0.0,
}


def fixture_scorer(df: DataFrame) -> DataFrame:
    return score_linear(df, FIXTURE_MODEL["weights"], FIXTURE_MODEL["intercept"],
                        FIXTURE_MODEL["centers"])


def prepared_flows(msgs: DataFrame, layout, stats: PrepStats, normalize: bool = False) -> DataFrame:
    """Parse, leave out rejects, dedup by fingerprint (watermark form on streams), transform."""
    valid, _rejects = split_rejects(msgs, layout, normalize=normalize)
    return prepare(dedup_by_key(valid), stats)


def store_flows(msgs: DataFrame, layout, path: str, normalize: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Messages deduplicated, parsed and marked (``reject_reason``) once into a
    stored table of ``columns`` (all), for queries that both fit and classify them.

    Parsed records are wide, so fingerprints alone are shuffled (half of the
    SHA-256, 16 bytes, tells payloads apart) and the records go straight to the table."""
    columns = columns or ["kafka_timestamp", "row_hash", *[n for n, _ in layout]]
    msgs = in_files(msgs, f"{path}-messages")
    key = F.substring(F.unhex(payload_hash("value", normalize)), 1, 16)
    for some in first_copies(msgs, key, f"{path}-first", "timestamp" if "kafka_timestamp" in columns else None):
        (tag_rejects(some, layout, normalize=normalize).select(*columns, "reject_reason")
         .write.mode("append").option("compression", "zstd").parquet(path))
    spark = msgs.sparkSession
    flows = spark.read.parquet(path)
    first = spark.read.parquet(f"{path}-first").agg(F.sum(F.bitmap_count("bits"))).first()[0] or 0
    if flows.count() != first:  # from the files' footers
        raise RuntimeError(f"the messages' files changed while they were read: {first} payloads, {flows.count()} stored")
    return flows


def prepared_stored(flows: DataFrame, stats: PrepStats) -> DataFrame:
    """``prepared_flows`` over the table of ``store_flows``."""
    return prepare(flows.where("reject_reason IS NULL").drop("reject_reason"), stats)


def classify(prepared: DataFrame, scorer: Callable[[DataFrame], DataFrame],
             class_map: dict[int, str]) -> DataFrame:
    return apply_prediction(scorer(prepared), class_map)


def fixture_stats(spark: SparkSession, sf_dir: str) -> PrepStats:
    """Fit the preprocessing statistics on the (deduplicated) fixture flows: only
    the features and the fingerprint pass through the dedup, a hash aggregate
    here, as nothing downstream filters on predictions."""
    flows = fixtures.flows(spark, sf_dir).select("kafka_timestamp", "row_hash", *fixtures.FIXTURE_FEATURES)
    return fit_stats(dedup_by_key(flows, payload_determined=True), fixtures.FIXTURE_FEATURES)


def fixture_classified(spark: SparkSession, sf_dir: str, stats: PrepStats | None = None) -> DataFrame:
    stats = stats or fixture_stats(spark, sf_dir)
    prepared = prepared_flows(fixtures.messages(spark, sf_dir), fixtures.FIXTURE_LAYOUT, stats)
    return classify(prepared, fixture_scorer, fixtures.FIXTURE_CLASS_MAP)


class FixtureLogisticModel:
    """The fixture scorer as a foreign ``predict_proba`` model (numpy), used to
    exercise the pandas-UDF scoring path with a known answer."""

    def __init__(self, model: dict = FIXTURE_MODEL, features=("f_value", "f_k")):
        self.model, self.features = model, list(features)

    def predict_proba(self, x):
        import numpy as np
        z = np.full(len(x), float(self.model["intercept"]))
        for c in self.features:
            z = z + self.model["weights"][c] * (x[c].to_numpy(dtype=float) - self.model["centers"][c])
        p1 = 1.0 / (1.0 + np.exp(-z))
        return np.stack([1.0 - p1, p1], axis=1)
