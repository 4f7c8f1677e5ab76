"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a vector of hashed byte trigrams: counts are damped by a logarithm, weighted by
the inverse document frequency in the labelled sample and normalised. The leading right
singular vectors of the labelled sample project it to a latent-semantic vector. Each
document's vector is multiplied with those of all labelled documents in blocks (exact
cosines, no index), and its ``K`` nearest vote with their similarity to a power; the score is
the share of the votes for label 1, drawn towards the label's share in the sample.

The projection and the labelled vectors come from at most ``SAMPLE`` different labelled texts
(and ``SAMPLE_BYTES``), chosen by a hash of doc_id, so what is broadcast has a fixed bound (``SAMPLE * RANK`` and
``BUCKETS * RANK`` single-precision numbers). Scoring is one pass without a shuffle.

Defined cases: null, empty and very short texts have a zero vector and get the sample's
share of label 1 (0.5 without labels); of equally near neighbours the first in the sample's
order vote; repeated rows score alike; a null doc_id goes by the empty text's remainder (0,
not held out) and is never learned from; other columns are ignored.
"""

from __future__ import annotations

import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.llm.common import labelled_sample, row_id, workers_ready

#: Labelled texts that are learned from and broadcast as vectors, at most.
SAMPLE = 4000
BUCKETS, RANK = 2048, 48
#: Voting neighbours, the power of their similarity, and votes of the sample's share.
K, POWER, PRIOR = 15, 8, 0.5
#: How much more a repeated word weighs than a trigram of the same frequency.
AGAIN = 8.0
#: Documents multiplied with the labelled vectors at a time.
BLOCK = 256


def counts(text: bytes):
    """Occurrences of each hashed trigram of bytes (digits count as one), then of words that
    repeat the word before them."""
    import numpy as np
    out = np.zeros(BUCKETS + 1, np.float32)
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(a) < 3:
        return out
    a = np.where((a >= 48) & (a <= 57), np.uint32(48), a)
    h = (a[:-2] * np.uint32(65536) + a[1:-1] * np.uint32(256) + a[2:]) * np.uint32(2654435761)
    out[:BUCKETS] = np.bincount(h >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    words = text.split()
    out[BUCKETS] = sum(map(operator.eq, words, words[1:]))
    return out


def normalised(x):
    import numpy as np
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def fit(sample: list[tuple[str, int]]):
    """Projection (with the term weights), labelled vectors, their labels and the share of label 1."""
    import numpy as np
    if not sample:
        return np.zeros((BUCKETS + 1, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32), 0.5
    raw = np.stack([counts(t.encode()) for t, _ in sample])
    idf = np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))).astype(np.float32) + 0.1
    idf[BUCKETS] *= AGAIN
    x = normalised(np.log1p(raw) * idf).astype(np.float32)
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    project = vectors[:, ::-1][:, :RANK].astype(np.float32)
    y = np.array([y for _, y in sample], np.float32)
    return (idf[:, None] * project).astype(np.float32), normalised(x @ project).astype(np.float32), y, float(y.mean())


def nearest(similar, k: int):
    """Columns of the k largest values of each row; of equal values the first ones."""
    import numpy as np
    edge = -np.partition(-similar, k - 1, axis=1)[:, k - 1:k]
    above, level = similar > edge, similar == edge
    taken = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    return np.nonzero(taken)[1].reshape(-1, k)


def votes(rows, model):
    """Scores of a block of trigram counts."""
    import numpy as np
    project, known, y, share = model
    if not len(known):
        return np.full(len(rows), share)
    z = normalised(np.log1p(rows) @ project)
    similar = z @ known.T
    k = min(K, len(known))
    order = nearest(similar, k)
    near = np.take_along_axis(similar, order, axis=1)
    weight = np.maximum(near, 0.0) ** POWER
    s = ((weight * y[order]).sum(axis=1) + PRIOR * share) / (weight.sum(axis=1) + PRIOR)
    return np.clip(s.astype(np.float64), 0.0, 1.0)


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, text -> doc_id, score."""
    workers_ready(docs.sparkSession, BLOCK)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                rows = np.stack([counts(t or b"") for t in b.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(votes(rows, shared.value), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held_fold: int = 1, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labelled rows outside the held-out fold."""
    rest = row_id() % folds
    texts = labelled_sample(docs, labels, "quality", rest != held_fold, sample)
    return score(docs, fit(texts)).select(
        "doc_id", (rest == held_fold).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
