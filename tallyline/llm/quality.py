"""Text quality by supervised subword embeddings.

Every word (a piece between white space, case and signs kept) and every run of three to five characters
of it, its ends marked, is a feature; features are hashed into ``BUCKETS`` learned vectors. A word that
stands twice in a row adds one feature more, the same for all words. A document is the mean of its features' vectors, and a softmax layer gives the chance of either label. Vectors and layer are
trained by stochastic gradient descent in numpy, in one task, on at most ``EXAMPLES`` labelled
documents (those with the smallest hash of their key; this is the bound on the labels that are read).

The output is linear in the mean, so that scoring needs one number per bucket: what a feature with that
hash adds to the difference of the two outputs. That table (``BUCKETS`` numbers of 8 bytes) goes to all
tasks, which add up the features of whole texts word by word.

Null and empty texts have no feature and get the chance that the layer's constants give. Without usable
labels every score is 0.5. Labels count where the key is not null and the label is 0 or 1; a document
with both labels is not learned from; of several texts under one key the least is. Rows are scored one
by one, so that repeated rows and null keys stay. Labels, language, source and key are no inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.words import texts_of

EXAMPLES, BUCKETS, WIDTH, RATE = 4_000, 1 << 17, 8, 0.5
# Passes over the examples, and steps at least: few examples are passed over more often.
PASSES, STEPS = 6, 4_000
SHORTEST, LONGEST = 3, 5
# Words that a worker remembers, and the longest word that it does: at most some 100 MB.
CACHED_WORDS, CACHED_LENGTH = 250_000, 64


def features(word: bytes) -> Iterator[int]:
    """Buckets of a word and of the runs of characters in it."""
    yield crc32(word) % BUCKETS
    marked = f"<{word.decode()}>"
    for n in range(SHORTEST, LONGEST + 1):
        for at in range(len(marked) - n + 1):
            yield crc32(marked[at:at + n].encode(), n) % BUCKETS


def repeats(words: list[bytes]) -> int:
    return sum(map(eq, words, islice(words, 1, None)))


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's features, the one of repeated words last, and the share of each."""
    times, words = np.zeros(BUCKETS + 1), text.split()
    for word, n in Counter(words).items():
        for bucket in features(word):
            times[bucket] += n
    times[BUCKETS] = repeats(words)
    held = np.flatnonzero(times)
    return held, (times[held] / max(times.sum(), 1.0)).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """What each bucket adds to the difference of the outputs, and their constant."""
    rnd = np.random.default_rng(11)
    vectors = rnd.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS + 1, WIDTH)).astype(np.float32)
    layer, constant = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    passes = max(PASSES, -(-STEPS // len(bags)))
    steps, done = passes * len(bags), 0
    for _ in range(passes):
        for n in rnd.permutation(len(bags)):
            held, share = bags[n]
            rate = RATE * (1 - done / steps)
            done += 1
            found = vectors[held]
            mean = share @ found
            out = mean @ layer + constant
            error = np.exp(out - out.max())
            error /= error.sum()
            error[labels[n]] -= 1
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            constant -= rate * 0.1 * error
            # The step of a vector isn't divided by the number of features, or long texts would teach nothing.
            vectors[held] = found - np.outer(np.sqrt(share), rate * back)
    if len(set(labels.tolist())) < 2:  # one label teaches no difference
        return np.zeros(BUCKETS + 1), float(constant[1] - constant[0])
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(float), float(constant[1] - constant[0])


_BAG = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("held", pa.binary()), ("share", pa.binary())])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n, text in enumerate(texts_of(batch.column("text"))):
            held, share = bag(text)
            yield pa.RecordBatch.from_arrays([batch.column("id")[n:n + 1], batch.column("label")[n:n + 1], *[
                pa.array([c.tobytes()], pa.binary()) for c in (held.astype(np.int32), share)]], schema=_BAG)


_MODEL = pa.schema([("adds", pa.binary()), ("constant", pa.float64())])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bags, labels = [], []
    for batch in batches:
        labels += batch.column("label").to_pylist()
        bags += [(np.frombuffer(h.as_py(), np.int32), np.frombuffer(s.as_py(), np.float32))
                 for h, s in zip(batch.column("held"), batch.column("share"))]
    if bags:
        adds, constant = train(bags, np.array(labels))
        yield pa.RecordBatch.from_arrays([pa.array([adds.tobytes()], pa.binary()), pa.array([constant])], schema=_MODEL)


class _Known(dict):
    """Word -> what its features add, and how many they are, as one complex number."""

    def __init__(self, adds: np.ndarray):
        super().__init__()
        self.adds = adds.tolist()

    def __missing__(self, word: bytes) -> complex:
        total, n = 0.0, 0
        for bucket in features(word):
            total += self.adds[bucket]
            n += 1
        if len(word) > CACHED_LENGTH:
            return complex(total, n)
        if len(self) >= CACHED_WORDS:
            self.clear()
        made = self[word] = complex(total, n)
        return made

    def text(self, text: bytes) -> complex:
        words = text.split()
        return sum(map(self.__getitem__, words), repeats(words) * complex(self.adds[BUCKETS], 1))


def _scores(packed: bytes | None, constant: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(np.frombuffer(packed, float) if packed else np.zeros(BUCKETS + 1))
        for batch in batches:
            sums = np.array([known.text(text) for text in texts_of(batch.column(1))], complex)
            out = sums.real / np.maximum(sums.imag, 1) + constant
            score = 1 / (1 + np.exp(-np.clip(out, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])
    return run


def held_out(key: str) -> Column:
    """Rows that no label is learned from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality") -> DataFrame:
    """(id, score) of every row of ``docs``: the chance of label 1."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id")).groupBy("id").agg(
        F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(EXAMPLES)
    examples = named.join(F.broadcast(sample), "id").groupBy("id", "label").agg(  # EXAMPLES rows are broadcast at most
        F.min(F.coalesce("text", F.lit(""))).alias("text"))
    bags = examples.mapInArrow(_bags, "id long, label int, held binary, share binary")
    model = bags.repartition(1).sortWithinPartitions("id").mapInArrow(_trained, "adds binary, constant double").first()
    adds, constant = (bytes(model["adds"]), model["constant"]) if model else (None, 0.0)
    return named.mapInArrow(_scores(adds, constant), "id long, score double").withColumnRenamed("id", id_col)
