"""Language by compression: the language whose dictionary compresses a text best.

For each language a bounded sample of labelled texts is the raw content of a
zstandard dictionary.  A text is encoded with every dictionary, in pieces, over
its whole length; the smallest total wins.  The margin to the runner-up, as a
share of the text, decides whether the answer is accepted.

Defined results: a null text or one without a letter is ``und`` with score 0 and
not accepted; equal sizes go to the language with more training texts, then to
the first in order; null labels are never learned; with no labelled text at all
every answer is ``und``.  Rows that repeat are judged alike, each for itself.
Columns of the input other than text are neither read nor changed; an input
column named as an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.arrays import trim
from lakeworks.llm.compress import compressors, fill, pieces

#: Bounds of the training sample, for each language: texts, characters of each, bytes of the dictionary.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 1000, 110_000
LEVEL = 6
#: Bytes saved over the runner-up, as a share of the text, below which an answer is not accepted.
LEAST_MARGIN = 0.002
UNKNOWN = "und"
#: Texts of fewer bytes are encoded behind a carrier that any dictionary compresses alike.
SHORT, CARRIER = 256, b"a" * 64


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, most frequent language first."""

    dictionaries: dict[str, bytes]
    level: int = LEVEL


def sample_by_label(
    labelled: DataFrame, label: str, text: str, key: str, most: int, chars: int
) -> dict[str, tuple[int, list[str]]]:
    """Count of each label and at most ``most`` text beginnings of it, chosen by a hash.

    A threshold on the hash is set from the counts, so no task ever gathers a
    label's rows: only about twice the wanted number pass it.  The hash is taken
    over key, text and the row's place in its partition, so rows that share an id,
    have none, or are the same in all, pass or fail each for itself.
    """
    rows = labelled.filter(F.col(label).isNotNull() & (F.length(text) > 0)).select(
        F.col(label).cast("string").alias("label"),
        F.substring(F.col(text), 1, chars).alias("text"),
        F.xxhash64(F.lit("sample"), F.col(key), F.col(text), F.monotonically_increasing_id()).alias("h"),
    )
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if not counts:
        return {}
    steps = 1 << 40
    share = F.create_map(
        *[F.lit(x) for name, n in counts.items() for x in (name, int(min(1.0, 2 * (most + 16) / n) * steps))]
    )
    picked = rows.filter(F.pmod("h", F.lit(steps)) < share[F.col("label")])
    by_label: dict[str, list] = {name: [] for name in counts}
    for r in picked.collect():
        by_label[r["label"]].append((r["h"], r["text"]))
    return {name: (counts[name], [t for _, t in sorted(rows)[:most]]) for name, rows in by_label.items()}


def fit(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    most: int = SAMPLE_TEXTS,
    chars: int = SAMPLE_CHARS,
    size: int = DICTIONARY_BYTES,
) -> LanguageModel:
    """Dictionaries from a bounded sample: ``most`` texts of ``chars`` characters, ``size`` bytes a language."""
    found = sample_by_label(labelled, label, text, key, most, chars)
    order = sorted(found, key=lambda name: (-found[name][0], name))
    return LanguageModel({name: fill([t.lower() for t in found[name][1]], size) for name in order if found[name][1]})


def _judge(text: str | None, coders: dict) -> tuple[str, float, float]:
    if text is None or not coders or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0
    content = text.lower().encode(errors="replace")
    # a frame that saves nothing is stored raw; the carrier makes a few bytes' gain show in a short text
    parts = pieces(content) if len(content) >= SHORT else [CARRIER + content]
    sizes = [(sum(len(c.compress(p)) for p in parts), k) for k, c in enumerate(coders.values())]
    best, *others = sorted(sizes)
    margin = (others[0][0] - best[0]) / len(content) if others else 1.0
    # bits saved per byte over each other language, as odds
    gains = np.array([s - best[0] for s, _ in sizes], dtype=float) / len(content) * 60
    score = 1.0 / float(np.exp(-np.minimum(gains, 60)).sum())
    return list(coders)[best[1]], score, margin


def detect(
    docs: DataFrame,
    model: LanguageModel,
    text: str = "text",
    least_margin: float = LEAST_MARGIN,
    names: tuple[str, str, str] = ("lang_pred", "score", "accepted"),
) -> DataFrame:
    """The input's columns with language, score and whether the margin suffices."""
    # a bounded number of bytes a language; plain values, as workers may lack this package
    held = docs.sparkSession.sparkContext.broadcast((dict(model.dictionaries), model.level))

    kinds = {"lang": pa.string(), "score": pa.float64(), "margin": pa.float64()}

    @F.arrow_udf("lang string, score double, margin double")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = compressors(*held.value)
        for batch in batches:
            found = [_judge(t.as_py(), coders) for t in batch]
            columns = zip(*found) if found else [()] * len(kinds)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))
        del coders  # before memory is given back, as the worker is used again
        trim()

    judged = docs.withColumn("_language", judge(F.col(text)))
    values = (
        F.col("_language.lang"),
        F.col("_language.score"),
        (F.col("_language.lang") != UNKNOWN) & (F.col("_language.margin") >= least_margin),
    )
    return judged.withColumns(dict(zip(names, values))).drop("_language")
