"""Quality by compression: which of two dictionaries, good or bad, explains a text better.

A bounded sample of good and of bad labelled texts is the raw content of two
zstandard dictionaries.  A text is encoded with both, in pieces, over its whole
length.  The difference of the two sizes as a share of the text, and the share
the smaller size leaves, go through a logistic calibration that is fitted on
labelled texts outside the dictionaries, so the score is a probability.

Defined results: null and empty texts get a score like any other, from a
difference of zero; labels other than 0 and 1 and null labels are not learned; a
document labelled twice counts once, with the lower label; with only one class
to learn the score is that class's share, with none it is 0.5.  Repeated rows
are scored alike, each for itself.  Only the text column is an input of a score;
an input column named as an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.arrays import trim
from lakeworks.llm.compress import compressors, fill, pieces
from lakeworks.session import cut_lineage

#: Bounds of the training sample: texts a class and characters of each in a dictionary, its bytes, texts for calibration.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES, CALIBRATION_TEXTS = 500, 1000, 110_000, 3000
LEVEL = 6
THRESHOLD = 0.3
_STEPS = 1 << 40


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries of both classes and the weights of the calibration; no dictionaries: ``prior`` for all."""

    bad: bytes
    good: bytes
    weights: tuple[float, ...]
    prior: float = 0.5
    level: int = LEVEL


def features(text: str | None, coders: dict) -> tuple[float, float]:
    """Size difference (bad - good) and smaller size, both as a share of the text."""
    content = (text or "").encode(errors="replace")
    if not content:
        return 0.0, 0.0
    parts = pieces(content)
    bad, good = (sum(len(coders[k].compress(p)) for p in parts) for k in ("bad", "good"))
    return (bad - good) / len(content), min(bad, good) / len(content)


def _terms(difference: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Inputs of the calibration; a text that hardly compresses says no more than one that half does."""
    return np.column_stack([np.ones(len(share)), np.clip(difference, -0.2, 0.2) * 10, np.clip(share, 0, 0.5) * 2])


def calibrate(difference: np.ndarray, share: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Weights of a logistic model by Newton steps."""
    x, w = _terms(difference, share), np.zeros(3)
    penalty = ridge * np.eye(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    most: int = SAMPLE_TEXTS,
    chars: int = SAMPLE_CHARS,
    size: int = DICTIONARY_BYTES,
    calibration: int = CALIBRATION_TEXTS,
) -> QualityModel:
    """Learn from a bounded sample of the labelled documents, chosen by the hash of their keys."""
    known = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("h", F.pmod(F.xxhash64(F.lit("quality"), "key"), F.lit(_STEPS)))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return QualityModel(b"", b"", (), float(next(iter(counts), 0.5)))
    # the two samples are taken from the two ends of the hash range; each stays below half of it
    low = {c: int(min(0.5, 2 * most / n) * _STEPS) for c, n in counts.items()}
    high = int(_STEPS * (1 - min(0.5, calibration / total)))
    for_dictionary = F.col("h") < F.when(F.col("label") == 1, F.lit(low[1])).otherwise(F.lit(low[0]))
    chosen = known.filter(for_dictionary | (F.col("h") >= high)).withColumn("dictionary", for_dictionary)
    content = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    rows = cut_lineage(
        docs.select(F.col(key).alias("key"), content).join(F.broadcast(chosen), "key").drop("key"), "labelled"
    )
    beginnings = rows.filter("dictionary").select("label", "h", F.substring("text", 1, chars).alias("text")).collect()
    held = {
        name: fill([r["text"] for r in sorted(beginnings, key=lambda r: (r["h"], r["text"])) if r["label"] == c][:most], size)
        for c, name in ((0, "bad"), (1, "good"))
    }
    level = LEVEL

    @F.pandas_udf("difference double, share double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coders = compressors(held, level)
        for batch in batches:
            yield pd.DataFrame([features(t, coders) for t in batch], columns=["difference", "share"])

    points = rows.filter("not dictionary").select("label", measure("text").alias("m")).select("label", "m.*").toPandas()
    if not len(points):
        return QualityModel(b"", b"", (), counts[1] / total)
    weights = calibrate(points["difference"].to_numpy(), points["share"].to_numpy(), points["label"].to_numpy(float))
    return QualityModel(held["bad"], held["good"], weights, counts[1] / total, level)


def score(
    docs: DataFrame,
    model: QualityModel,
    text: str = "text",
    threshold: float = THRESHOLD,
    names: tuple[str, str] = ("score", "predicted"),
) -> DataFrame:
    """The input's columns, the probability of label 1 and the label at ``threshold``."""
    # two dictionaries of a bounded size; plain values, as workers may lack this package
    held = docs.sparkSession.sparkContext.broadcast((model.bad, model.good, model.weights, model.prior, model.level))

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bad, good, weights, prior, level = held.value
        coders = compressors({"bad": bad, "good": good}, level) if weights else {}
        for batch in batches:
            if not weights or not len(batch):
                yield pd.Series([prior] * len(batch), dtype="float64")
                continue
            points = np.array([features(t, coders) for t in batch])
            logits = _terms(points[:, 0], points[:, 1]) @ np.array(weights)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -30, 30))))
        trim()

    return docs.withColumn(names[0], rate(F.col(text).cast("string"))).withColumn(
        names[1], (F.col(names[0]) >= threshold).cast("int")
    )
