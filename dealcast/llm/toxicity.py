"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. Training
picks, for each class, the words that mark its texts (more frequent there by ``RATIO``, in
order of their log-odds weighted by documents) until the dictionary's budget is full; both
share the frequent ordinary words at equal distances from the text, so that a window without
marked words compresses to the same length under either. Every text is cut into windows of
whole words; the difference of a window's two compressed lengths says how much better the
toxic dictionary describes it. Mean, largest and thresholded differences of all windows make
a score by a logistic curve. The curve is calibrated on windows scored with dictionaries that
were trained on the other half of the labelled texts.

Only a bounded sample of different labelled texts reaches the driver (``SAMPLE`` rows and
``SAMPLE_BYTES``, chosen by a hash of doc_id); dictionaries of a few KB and a handful of numbers go to the workers. Scoring
is one pass over whole texts without a shuffle.

Defined cases: a null or empty text is one empty window and gets the score of no difference;
without both classes the score is the share of toxic labels (0 without labels); repeated rows
score alike; a null doc_id is held out as the empty text's remainder (0) says and is never
learned from; other columns are ignored.
"""

from __future__ import annotations

import collections
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.llm.common import labelled_sample, row_id, workers_ready

#: Labelled texts that are learned from, at most.
SAMPLE = 8000
#: Bytes of text in a window, and zstandard's level.
WINDOW, LEVEL = 96, 5
#: A marking word stands in at least MIN_DOCS texts of its class, RATIO times as often as in the other.
MIN_DOCS, RATIO = 3, 8.0
MARKED_BYTES, SHARED_BYTES = 8192, 16384
#: Thresholds of a window's difference in bytes whose shares the calibration weighs.
THRESHOLDS = (2, 3, 5)
EDGES = ".,;:!?&$%*#|\"'()"
#: Put before each window and at the end of both dictionaries, so that zstandard never
#: stores a short window raw, whose length would say nothing.
HEADER = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ@_~^=/[]{}<>0123456789"


def words_of(text: str) -> list[str]:
    return [w.strip(EDGES) for w in text.lower().split()]


def windows(text: str) -> list[bytes]:
    """The words of a text in windows of about WINDOW bytes; at least one."""
    out, held, size = [], [], 0
    for w in words_of(text):
        if held and size + len(w) >= WINDOW:
            out.append(HEADER + f" {' '.join(held)} ".encode())
            held, size = [], 0
        held.append(w)
        size += len(w) + 1
    out.append(HEADER + f" {' '.join(held)} ".encode())
    return out


def train(sample: list[tuple[str, int]]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and of the toxic dictionary."""
    held = (collections.Counter(), collections.Counter())
    n = [0, 0]
    for text, y in sample:
        n[y] += 1
        held[y].update(set(words_of(text)))

    def marked(y: int) -> list[str]:
        rated = []
        for w, here in held[y].items():
            ratio = (here + 0.5) / (n[y] + 1) / ((held[1 - y][w] + 0.5) / (n[1 - y] + 1))
            if here >= MIN_DOCS and len(w) > 2 and ratio >= RATIO:
                rated.append((-here * math.log(ratio), w))
        return [w for _, w in sorted(rated)]

    def packed(words, budget: int) -> bytes:
        out, size = [], 0
        for w in words:
            b = f" {w} ".encode()
            if size + len(b) > budget:
                break
            out.append(b)
            size += len(b)
        return b"".join(reversed(out))  # the best are nearest to the text

    marks = (marked(0), marked(1))
    told = set(marks[0]) | set(marks[1])
    shared = packed((w for w, _ in sorted(held[0].items(), key=lambda x: (-x[1], x[0])) if w and w not in told), SHARED_BYTES) + HEADER
    return packed(marks[0], MARKED_BYTES) + shared, packed(marks[1], MARKED_BYTES) + shared


class Distances:
    """Compressed lengths of windows under two dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard
        self.pair = []
        for content in (ordinary, toxic):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(LEVEL)
            self.pair.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def features(self, text: str | None) -> list[float]:
        """Bias, mean, largest and thresholded differences of a text's windows."""
        ordinary, toxic = self.pair
        d = [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text or "")]
        n = len(d)
        over = [sum(x >= t for x in d) for t in THRESHOLDS]
        return [1.0, sum(d) / n, max(d) / 10, math.log1p(max(0, sum(x - 1 for x in d if x > 1))),
                *(o / n * 10 for o in over), *(math.log1p(o) for o in over)]


def logistic(x, weights) -> float:
    z = sum(a * b for a, b in zip(x, weights))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def calibrate(rows: list[list[float]], labels: list[int], ridge: float = 1.0) -> list[float]:
    """Weights of a logistic curve by Newton's steps with a small ridge."""
    import numpy as np
    x, y = np.array(rows), np.array(labels, float)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(h, x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def fit(sample: list[tuple[str, int]]) -> tuple[bytes, bytes, list[float]]:
    """Both dictionaries and the calibration."""
    halves = [sample[0::2], sample[1::2]]
    rows, labels = [], []
    for k in (0, 1):
        if {y for _, y in halves[1 - k]} == {0, 1}:
            d = Distances(*train(halves[1 - k]))
            rows += [d.features(t) for t, _ in halves[k]]
            labels += [y for _, y in halves[k]]
    if set(labels) != {0, 1}:
        share = sum(y for _, y in sample) / len(sample) if sample else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return HEADER, HEADER, [math.log(share / (1 - share))]
    return (*train(sample), calibrate(rows, labels))


def score(docs: DataFrame, model: tuple[bytes, bytes, list[float]]) -> DataFrame:
    """doc_id, text -> doc_id, score."""
    workers_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        ordinary, toxic, weights = shared.value
        d = Distances(ordinary, toxic)
        for b in batches:
            s = [logistic(d.features(t), weights) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows outside the held-out fold."""
    rest = row_id() % folds
    texts = labelled_sample(docs, labels, "toxic", rest != held_fold, sample)
    return score(docs, fit(texts)).select(
        "doc_id", (rest == held_fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
