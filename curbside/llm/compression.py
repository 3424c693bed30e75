"""Quality by compression: zstandard dictionaries of good and of bad text.

A text is cut into windows of some hundred bytes; every window is compressed once with either dictionary. Short windows
matter: what a dictionary knows shows in each of them, while in a long run a text soon explains itself. The difference of
the two sizes over their sum goes through a curve fitted on labelled texts that are in neither dictionary: a logistic
function of the difference, bent at two scales, and weighted by how much there was to compress, so that a text of a few
words is as good as texts are on the whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.llm.common import remainder, unused

WINDOW = 128
LEVEL = 12
FRAME = 8  # bytes that any frame of this kind has besides its content, about
SCALES = (0.03, 0.1)  # of the difference, at which the curve may bend
EVIDENCE = 100.0  # compressed bytes of both sizes that count half

# Bounds of the fit. It reads at most so many labelled texts of either class, chosen by a hash of the id, none of them
# longer than MAX_CHARS, and puts at most DICTIONARY_BYTES of whole texts into a dictionary.
SAMPLE_ROWS = 3000
MAX_CHARS = 20_000
DICTIONARY_BYTES = 1_200_000


@dataclass(frozen=True)
class Model:
    """Two dictionaries and the curve: weights of its features, then the log odds of texts on the whole."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


class Sizer:
    """Compressed sizes of texts under a dictionary, in windows."""

    def __init__(self, content: bytes):
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
        ).compress

    def size(self, windows: list[bytes]) -> int:
        compress = self.compress
        return sum([len(compress(w)) for w in windows]) - FRAME * len(windows)


def windows_of(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "replace")
    return [raw[i : i + WINDOW] for i in range(0, len(raw), WINDOW)]


def sizes(good: Sizer, bad: Sizer, text: str | None) -> tuple[int, int]:
    windows = windows_of(text)
    return max(0, good.size(windows)), max(0, bad.size(windows))


def features(good, bad, tanh) -> list:
    """What the curve is a function of, for arrays and for columns: the normalised difference of the sizes at each scale,
    weighted by the evidence, and the evidence."""
    both = good + bad
    difference, evidence = (good - bad) / (both + 1.0), both / (both + EVIDENCE)
    return [*[tanh(difference / scale) * evidence for scale in SCALES], evidence]


def fit(rows: list[tuple[str, int]]) -> Model:
    """A model of (text, 0 or 1) rows. Half of them, as they come, fill the dictionaries; the rest set the curve.

    With one class or no rows at all the curve is flat at the share of ones, one half without rows.
    """
    content = {0: [], 1: []}
    used = {0: 0, 1: 0}
    rest = []
    for k, (text, label) in enumerate(rows):
        raw = text.encode("utf-8", "replace")
        if k % 2 == 0 and used[label] + len(raw) <= DICTIONARY_BYTES:
            content[label].append(raw)
            used[label] += len(raw)
        else:
            rest.append((text, label))
    good, bad = b"\n".join(content[1]) or b"\n" * 8, b"\n".join(content[0]) or b"\n" * 8
    y = np.array([label for _, label in rest], dtype=float)
    if len(set(y)) < 2:
        share = (sum(label for _, label in rows) + 1) / (len(rows) + 2)
        return Model(good, bad, (*[0.0] * (len(SCALES) + 1), float(np.log(share / (1 - share)))))
    g, b = Sizer(good), Sizer(bad)
    measured = np.array([sizes(g, b, text) for text, _ in rest], dtype=float)
    return Model(good, bad, tuple(logistic(np.column_stack(features(measured[:, 0], measured[:, 1], np.tanh)), y)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> list[float]:
    """Weights by damped Newton steps, lightly regularised, and the fixed log odds of `y` as the intercept."""
    share = y.mean()
    offset = float(np.log(share / (1 - share)))
    w, penalty = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])

    def loss(v: np.ndarray) -> float:
        z = x @ v + offset
        return float((np.logaddexp(0, z) - y * z).sum() + v @ penalty @ v / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return [*w.tolist(), offset]


def sample(docs: DataFrame, labels: DataFrame, learn_from: Column) -> list[tuple[str, int]]:
    """The labelled texts to fit on, both classes mixed in hash order: the same ones at every run.

    The class shares are kept, so that the curve knows how common either is. Null labels, ids and texts are left out;
    of contradicting labels the lower counts.
    """
    known = labels.where(F.col("quality").isin(0, 1) & learn_from).groupBy("doc_id").agg(F.min("quality").alias("q"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE_ROWS)
    rows = (
        docs.where(F.length("text") <= MAX_CHARS).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * SAMPLE_ROWS).select("text", "q")
    )
    return [(r.text, int(r.q)) for r in rows.toLocalIterator()]


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` and the probability that its text is good; null and empty texts are as good as texts are on the whole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("good bigint, bad bigint")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        good, bad = Sizer(shared.value.good), Sizer(shared.value.bad)
        for batch in batches:
            yield pd.DataFrame([sizes(good, bad, t) for t in batch], columns=["good", "bad"], dtype="int64")

    *weights, intercept = model.weights
    total = F.lit(float(intercept))
    for w, x in zip(weights, features(F.col(f"{name}.good"), F.col(f"{name}.bad"), F.tanh)):
        total = total + F.lit(float(w)) * x
    return docs.withColumn(name, measured(F.col("text"))).withColumn(name, 1.0 / (1.0 + F.exp(-total)))


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out (crc32 of the id mod `modulus` is `held`), score, predicted.

    Labels of held-out ids are never read. A null id counts as held out. Null and empty texts are scored alike; repeated
    rows stay; other columns are ignored.
    """
    model = fit(sample(docs, labels, remainder("doc_id", modulus) != held))
    scored = with_score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", modulus) == held, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """The rows of `docs` that are predicted good; columns as they were, whatever their names.

    Null and empty texts are as good as texts are on the whole; null ids are never learned from; of repeated rows all stay
    or none. No documents give none.
    """
    model = fit(sample(docs, labels, remainder("doc_id", modulus) != held))
    name = unused("quality", docs.columns)
    return with_score(docs, model, name).where(F.col(name) >= 0.5).drop(name)
