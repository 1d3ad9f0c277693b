"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax over two labels.

Trained by stochastic gradient descent in numpy on a bounded sample of labelled documents. Since the average and the
output layer are both linear, the trained model folds into one number per hash bucket, and a document's score needs the
mean of these numbers over its features only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from dayfold.llm.common import PIECE_BYTES, mixed, powers

BUCKET_BITS = 17
GRAMS = (2, 3, 4)
#: Words of the n-grams whose repetition in a text is a feature.
RUN = 3


@dataclass(frozen=True)
class Model:
    """What scoring needs: a number per bucket, and a constant."""

    weight: np.ndarray
    constant: float


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every feature of ``texts``: their words as they stand between white space, and their
    character n-grams, in which a word's ends count as characters; and for each word whether it and the next ones have
    stood together before in the text. Whole texts; an empty one has none."""
    chars = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    n = len(chars)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = (chars == 32) | ((chars >= 9) & (chars <= 13))
    values = mixed(np.where(blank, 32, chars).astype(np.uint64) + np.uint64(1))
    forward, back = powers(n + 2)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * forward[:n], out=sums[1:])
    at, bucket = [], []
    shift = np.uint64(64 - BUCKET_BITS)

    def add(starts, stops, salt):
        h = (sums[stops] - sums[starts]) * back[starts] + np.uint64(salt)
        bucket.append((h * np.uint64(0xD6E8FEB86659FD93) >> shift).astype(np.int64))
        at.append(starts)

    edge = np.flatnonzero(blank)
    starts = np.r_[0, edge[:-1] + 1]
    words = edge > starts
    add(starts[words], edge[words], 1)
    # word n-grams share two buckets: new in their text, and seen before in it
    first, last = starts[words], edge[words]
    text_of = np.searchsorted(ends, first, "right")
    whole = np.flatnonzero(text_of[: max(0, len(first) - RUN + 1)] == text_of[RUN - 1 :])
    grams = mixed((sums[last[whole + RUN - 1]] - sums[first[whole]]) * back[first[whole]]) ^ mixed(text_of[whole].astype(np.uint64))
    seen = np.ones(len(whole), np.int64)
    seen[np.unique(grams, return_index=True)[1]] = 0
    at.append(first[whole])
    bucket.append(seen)
    inner = np.r_[0, np.cumsum(blank)]
    for size in GRAMS:
        if n > size:
            start = np.arange(-1 if size > 2 else 0, n - size)
            start = start[start >= 0]
            crossed = inner[start + size - 1] - inner[start + 1] if size > 2 else blank[start] & blank[start + 1]
            start = start[crossed == 0]
            add(start, start + size, size)
    position = np.concatenate(at)
    return np.searchsorted(ends, position, "right"), np.concatenate(bucket)


def train(texts: list[str], labels: np.ndarray, size: int = 8, rounds: int = 5, rate: float = 2.0, seed: int = 7) -> Model:
    """SGD over documents in random order; the rate falls to nothing. With no or one label the score is its share."""
    labels = np.asarray(labels, np.int64)
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    start = float(np.log(share / (1 - share)))
    buckets = 1 << BUCKET_BITS
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(buckets, np.float32), start)
    rows = []
    for text in texts:
        _, bucket = features([text])
        found, count = np.unique(bucket, return_counts=True)
        rows.append((found.astype(np.int32), (count / max(1, count.sum())).astype(np.float32)))
    random = np.random.RandomState(seed)
    vectors = random.uniform(-1.0 / size, 1.0 / size, (buckets, size)).astype(np.float32)
    output, constant = np.zeros((2, size), np.float32), np.array([0.0, start], np.float32)
    step, steps = 0, rounds * len(rows)
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            found, share_of = rows[i]
            pace = rate * (1 - step / steps)
            step += 1
            hidden = share_of @ vectors[found]
            logit = output @ hidden + constant
            chance = np.exp(logit - logit.max())
            error = chance / chance.sum()
            error[labels[i]] -= 1
            back = error @ output
            output -= pace * np.outer(error, hidden).astype(np.float32)
            constant -= np.float32(pace * 0.05) * error.astype(np.float32)
            vectors[found] -= (np.float32(pace * 20) * share_of)[:, None] * back.astype(np.float32)
    return Model((vectors @ (output[1] - output[0])).astype(np.float32), float(constant[1] - constant[0]))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, chars: int) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``rows`` labelled documents that are not held out, chosen by hash; ``chars`` bounds
    the length of the texts among them. Rows without id, text or label are no examples; a document with several labels
    counts by their majority."""
    one = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
    one = one.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").where(F.length("text") <= chars).join(chosen, "doc_id").select("doc_id", "text", "label")
    # several documents of one id: bounded again
    table = found.orderBy(F.xxhash64("doc_id", "text")).limit(rows).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return table.column("text").to_pylist(), table.column("label").to_numpy()


def fit(docs: DataFrame, labels: DataFrame, rows: int = 3000, chars: int = 50_000) -> Model:
    """A model from a bounded sample of ``labels`` (doc_id, quality) and their ``docs`` (doc_id, text)."""
    return train(*labelled_sample(docs, labels, rows, chars))


def text_scores(model: Model, texts: list[str]) -> np.ndarray:
    index, bucket = features(texts)
    total = np.bincount(index, model.weight[bucket], len(texts))
    logit = total / np.maximum(np.bincount(index, minlength=len(texts)), 1) + model.constant
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 of every whole text in a column ``name``, which must be new. NULL text
    counts as empty, and an empty one gets the model's constant. Other columns and repeated rows stay as they are."""
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: 2^BUCKET_BITS numbers
    at = docs.columns.index("text")

    def score(batches):
        own = shared.value
        for batch in batches:
            first = 0
            while first < batch.num_rows:  # slices of bounded text, or one longer text
                texts, held, last = [], 0, first
                while last < batch.num_rows and (last == first or held < PIECE_BYTES):
                    texts.append(batch.column(at)[last].as_py() or "")
                    held += len(texts[-1])
                    last += 1
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text_scores(own, texts))], [*part.schema.names, name])
                first = last

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
