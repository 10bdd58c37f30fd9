"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Examples are a bounded sample of labelled documents (``EXAMPLES``, those with the smallest hash of
their id). Terms are words and beginnings of words; of these the index holds all that are associated with
either label among all examples, as others only add noise to a cosine. Associated is what one example in
``EXAMPLES_A_TERM`` holds, three to six of them, what one label holds ``LEAST_LIFT`` times as often as the
other, and what lies so many standard errors apart as the largest of as many chance differences would,
sqrt(2 ln(terms)). Among n examples a term can lie the square root of n
apart at most, so that very few examples ask for ``LEAST_SHARE`` of that root, and an eighth of them. Document
frequencies are counted over all documents. An example whose shingles have a similarity of 3/4 with
those of one with a smaller id that shares one of four minima with it, confirmed on the full sets, joins
it; such examples and those with equal vectors are one entry with its numbers of toxic and clean
examples, so that no example and no label is lost. An entry's postings lie in blocks with
their largest weight per term, so that the blocks are visited from the best bound on and left as soon
as no other block can hold one of the ``NEAREST`` entries; the search is exact. Entries vote with a
power of their cosine, and an isotonic fit on the examples' own votes, each without itself, turns
votes into probabilities. A document with none of the terms gets the share of toxic ones among such
examples. Without any usable label every score is 0.

Null and empty texts have no terms. Labels are read only where the key is given and the label is 0 or
1; a document with both labels counts as toxic. Rows are scored one by one, so repeated rows and null
keys stay. Labels, language, source and key are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.shingles import shingle_sets
from tallyline.llm.store import staged
from tallyline.llm.words import forget_encoders, texts_of

EXAMPLES, NEAREST, BLOCK = 20_000, 24, 64
# Blocks that a search reads first; each time after, it reads four times as many of those that may matter.
FIRST_BLOCKS = 16
# Members of one leader that are compared with it in one place.
MEMBERS = 256
EXAMPLES_A_TERM, LEAST_LIFT, LEAST_SHARE = 500, 2, 0.4
POWER = 6
# Pieces of text that a worker remembers, and the bytes of all of them and their terms.
CACHED_PIECES, CACHED_BYTES = 200_000, 16 << 20
# Vectors whose score a worker remembers.
REMEMBERED = 20_000
_WORD = re.compile(r"\w+")


def terms_of(word: bytes) -> list[str]:
    """Words in one white-space separated piece of text, and their first four and five letters."""
    found = []
    for w in _WORD.findall(word.decode().lower()):
        found.append(w)
        found.extend(w[:n] + "*" for n in (4, 5) if len(w) > n)
    return found


class _Known(dict):
    """Piece of text -> numbers of its indexed terms, as 32-bit integers."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers, self.held = numbers, 0

    def __missing__(self, word: bytes) -> bytes:
        found = [self.numbers[t] for t in terms_of(word) if t in self.numbers]
        made = np.array(found, np.int32).tobytes()
        self.held += len(word) + len(made)
        if len(self) >= CACHED_PIECES or self.held > CACHED_BYTES:
            self.clear()
            self.held = len(word) + len(made)
        self[word] = made
        return made


_EXAMPLE = pa.schema([("id", pa.int64()), ("toxic", pa.int32()), ("text", pa.string()),
                      ("items", pa.list_(pa.int64())), ("minima", pa.list_(pa.int64()))])


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's shingles, and their four minima under four orders."""
    turns = np.array([0, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x14057B7EF767814F])
    forget_encoders()
    for batch in (whole.slice(at, 256) for whole in batches for at in range(0, len(whole), 256)):
        sets = [shingle_sets([t])[0] for t in texts_of(batch.column("text"))]
        minima = [[int((s ^ t).min()) for t in turns] if len(s) else [] for s in sets]
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.list_(pa.int64())) for c in (sets, minima)]], schema=_EXAMPLE)


def near_copies(examples: DataFrame) -> dict[int, int]:
    """Examples (id, items, minima) that join another one -> that one, which has a smaller id and joins none."""
    minima = examples.select("id", F.posexplode("minima").alias("turn", "value"))
    leaders = minima.groupBy("turn", "value").agg(F.min("id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    pairs = minima.join(F.broadcast(leaders.drop("n")), ["turn", "value"]).where("id <> leader").select("id", "leader").distinct()
    pairs = staged(pairs, "example-pairs")  # four per example at most
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    first = sizes.join(examples.select(F.col("id").alias("leader"), F.col("items").alias("ib")), "leader").select(
        "leader", "ib", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    second = pairs.join(F.broadcast(sizes), "leader").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).join(
        examples.select("id", F.col("items").alias("ia")), "id")
    both = second.join(first, ["leader", "part"]).select(
        "id", "leader", F.size("ia").cast("long").alias("na"), F.size("ib").cast("long").alias("nb"),
        F.size(F.array_intersect("ia", "ib")).cast("long").alias("both"))
    confirmed = both.where("100 * both >= 75 * (na + nb - both)").select("id", "leader").collect()  # four per example at most
    joined: dict[int, int] = {}
    for key, leader in sorted(map(tuple, confirmed)):
        if leader not in joined:
            joined.setdefault(key, leader)
    return joined


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    schema = pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def given() -> pa.RecordBatch:
        names = list({**toxic, **clean})
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()),
                                           pa.array([clean[n] for n in names], pa.int64())], schema=schema)

    for batch in batches:
        for text, label in zip(texts_of(batch.column("text")), batch.column("toxic").to_pylist()):
            (toxic if label else clean).update({t for w in set(text.split()) for t in terms_of(w)})
            if len(toxic) + len(clean) > 500_000:
                yield given()
                toxic.clear()
                clean.clear()
    yield given()


_VECTOR = pa.schema([("id", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])


def _vectors(numbers: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        known = _Known(numbers)
        for batch in batches:
            terms, times = [], []
            for text in texts_of(batch.column(1)):
                found = np.frombuffer(b"".join(map(known.__getitem__, text.split())), np.int32)
                held, n = np.unique(found, return_counts=True)
                terms.append(held)
                times.append(n.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.list_(pa.int32())) for c in (terms, times)]],
                                             schema=_VECTOR)
    return run


def _frequencies(terms: int):
    """Documents that hold each term: one row per term that a task has met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, np.int64)
        for batch in batches:
            held += np.bincount(pc.list_flatten(batch.column("terms")).to_numpy(), minlength=terms)
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(held[found])], names=["term", "n"])
    return run


class BlockMaxIndex:
    """Exact nearest entries by cosine. ``vectors``: (terms, weights) of unit length, one per entry."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        self.n, self.blocks = len(vectors), -(-len(vectors) // BLOCK)
        entry = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors] or [np.empty(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or [np.empty(0)])
        order = np.lexsort((entry, term))
        self.entry, self.weight = entry[order], weight[order]
        # One segment per (term, block): its first posting and its largest weight.
        key = term[order] * max(self.blocks, 1) + self.entry // BLOCK
        firsts = np.flatnonzero(np.diff(key, prepend=-1))
        self.first = np.append(firsts, len(key))
        self.block = key[firsts] % max(self.blocks, 1)
        self.top = np.maximum.reduceat(self.weight, firsts) if len(firsts) else np.empty(0)
        self.of_term = np.searchsorted(key[firsts] // max(self.blocks, 1), np.arange(terms + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the k largest positive cosines, ties to the smaller entry."""
        spans = [np.arange(self.of_term[t], self.of_term[t + 1]) for t in terms]
        segments = np.concatenate(spans) if spans else np.empty(0, np.int64)
        if not len(segments):
            return np.empty(0, np.int64), np.empty(0)
        factor = np.repeat(weights, [len(s) for s in spans])
        bounds = np.bincount(self.block[segments], factor * self.top[segments], self.blocks)
        visit = np.argsort(-bounds, kind="stable")
        visit = visit[bounds[visit] > 0]
        of = self.block[segments]
        entries, cosines, at, size = np.empty(0, np.int64), np.empty(0), 0, FIRST_BLOCKS
        while at < len(visit):
            chosen = visit[at:at + size]
            if len(cosines) >= k:  # blocks that can hold something better
                chosen = chosen[bounds[chosen] >= cosines[-1] - 1e-9]
                if not len(chosen):
                    break
            wanted = np.zeros(self.blocks, bool)
            wanted[chosen] = True
            held = np.flatnonzero(wanted[of])
            first = self.first[segments[held]]
            sizes = self.first[segments[held] + 1] - first
            postings = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            sums = np.bincount(self.entry[postings], np.repeat(factor[held], sizes) * self.weight[postings], self.n)
            hit = np.flatnonzero(sums)
            entries, cosines = np.concatenate([entries, hit]), np.concatenate([cosines, sums[hit]])
            if len(cosines) > k:
                near = np.flatnonzero(cosines >= np.partition(cosines, -k)[-k] - 1e-11)
                entries, cosines = entries[near], cosines[near]
            best = np.lexsort((entries, -np.round(cosines, 12)))[:k]
            entries, cosines = entries[best], cosines[best]
            at, size = at + size, size * 4
        return entries, cosines


class Examples:
    """The fitted model: term weights, the index, the votes of its entries and the calibration."""

    def __init__(self, rows: list[tuple[int, int, list[int], list[int]]], frequencies: np.ndarray, n_docs: int,
                 joined: dict[int, int] | None = None):
        """``rows``: (id, toxic, terms, times); ``joined``: ids that count in the entry of another one."""
        joined, held_by = joined or {}, {}
        self.idf = np.log((1 + n_docs) / (1 + frequencies)) + 1
        entries: dict[bytes, list] = {}
        for key, toxic, terms, times in sorted(rows, key=lambda r: r[0]):
            if key in joined:
                held = held_by[joined[key]]
            else:
                vector = self.unit(np.array(terms, np.int64), np.array(times))
                held = entries.setdefault(vector[0].tobytes() + np.round(vector[1], 9).tobytes(), [vector, [], 0])
                held_by[key] = held
            held[1].append(key)
            held[2] += toxic
        empty = entries.pop(b"", [None, [], 0])
        self.plain = (len(empty[1]), empty[2])
        # Alike entries share blocks: by their heaviest term.
        found = sorted(entries.values(), key=lambda e: (int(e[0][0][np.argmax(e[0][1])]), -float(e[0][1].max())))
        self.keys = [e[1][0] for e in found]
        self.n = np.array([len(e[1]) for e in found], float)
        self.toxic = np.array([e[2] for e in found], float)
        self.index = BlockMaxIndex([e[0] for e in found], len(self.idf))
        total = len(rows)
        self.prior = sum(r[1] for r in rows) / total if total else 0.0
        self.steps = np.empty(0), np.empty(0)
        votes, labels, weights = [], [], []
        for at, (vector, keys, toxic) in enumerate(found):
            for label, n in ((1, toxic), (0, len(keys) - toxic)):
                if n:
                    votes.append(self.vote(*vector, without=(at, label))[0])
                    labels.append(label)
                    weights.append(n)
        for label, n in ((1, empty[2]), (0, len(empty[1]) - empty[2])):
            if n:
                votes.append(self.vote(np.empty(0, np.int64), np.empty(0))[0])
                labels.append(label)
                weights.append(n)
        self.steps = isotonic(np.array(votes), np.array(labels, float), np.array(weights, float))
        self.remembered: dict[bytes, tuple] = {}

    def unit(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.log1p(times) * self.idf[terms]
        return terms, w / np.sqrt((w * w).sum()) if len(w) else w.astype(float)

    def vote(self, terms: np.ndarray, weights: np.ndarray, without: tuple[int, int] | None = None) -> tuple:
        """Share of toxic votes, and the entries and cosines that gave them."""
        entries, cosines = self.index.nearest(terms, weights, NEAREST)
        if not len(entries):
            n, toxic = self.plain
            return (toxic + self.prior) / (n + 1), entries, cosines
        n, toxic = self.n[entries], self.toxic[entries]
        if without:
            mine = entries == without[0]
            n, toxic = n - mine, toxic - mine * without[1]
        # Many equal examples speak louder than one, but not in proportion.
        w = cosines ** POWER * np.where(n > 0, np.log1p(n) / np.maximum(n, 1), 0)
        return (float((w * toxic).sum()) + 0.1 * self.prior) / (float((w * n).sum()) + 0.1), entries, cosines

    def score(self, terms: list[int], times: list[int]) -> tuple[float, list[int], list[float]]:
        key = np.array([terms, times], np.int32).tobytes()
        found = self.remembered.get(key)
        if found is None:
            vote, entries, cosines = self.vote(*self.unit(np.array(terms, np.int64), np.array(times)))
            score = float(np.interp(vote, *self.steps)) if len(self.steps[0]) else 0.0
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            found = self.remembered[key] = score, [self.keys[e] for e in entries[:5]], cosines[:5].tolist()
        return found


def isotonic(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points of a rising line from votes to shares of label 1."""
    blocks: list[list[float]] = []
    for i in np.argsort(votes, kind="stable"):
        blocks.append([weights[i] * labels[i], weights[i], votes[i] * weights[i]])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            blocks[-2:] = [[a + b for a, b in zip(*blocks[-2:])]]
    return (np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])) if blocks else (
        np.empty(0), np.empty(0))


_SCORED = pa.schema([("id", pa.int64()), ("score", pa.float64()), ("evidence", pa.list_(pa.int64())),
                     ("cosines", pa.list_(pa.float64()))])


def _scores(model: Examples):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(a, b) for a, b in zip(batch.column("terms").to_pylist(), batch.column("times").to_pylist())]
            columns = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[
                pa.array(c, t) for c, t in zip(columns, _SCORED.types[1:])]], schema=_SCORED)
    return run


def held_out(key) -> F.Column:
    """Rows that no label is learned from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, label_docs: DataFrame | None = None, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(id, score, evidence, cosines) of every row of ``docs``.

    ``label_docs``: where the labelled texts are, if not in ``docs``. evidence: ids of the nearest
    examples, one per entry; cosines: theirs.
    """
    named = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).where(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(EXAMPLES)  # so many rows at most: small enough to be broadcast
    texts = named(docs if label_docs is None else label_docs).join(F.broadcast(sample), "id").select("id", "toxic", "text")
    examples = staged(texts.dropDuplicates(["id"]).mapInArrow(
        _sketched, "id long, toxic int, text string, items array<long>, minima array<long>"), "examples")
    joined = near_copies(examples)
    examples = examples.select("id", "toxic", "text")

    by_label = {r["toxic"]: r["count"] for r in examples.groupBy("toxic").count().collect()}
    n1, n0 = by_label.get(1, 0), by_label.get(0, 0)
    counts = examples.mapInArrow(_term_counts, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    share = (F.col("a") + F.col("b")) / F.lit(max(n1 + n0, 1))
    # A term of all examples has no error; it tells nothing and stays out with a null.
    z = F.try_divide(F.col("a") / F.lit(max(n1, 1)) - F.col("b") / F.lit(max(n0, 1)), F.sqrt(
        share * (1 - share) * F.lit(1 / max(n1, 1) + 1 / max(n0, 1))))
    n = n1 + n0
    least = max(min(min(max(n // EXAMPLES_A_TERM, 3), 6), n // 8), 2)
    common = staged(counts.where(F.col("a") + F.col("b") >= least).withColumn("z", F.abs(z)), "common-terms")
    rates = F.col("a") / F.lit(max(n1, 1)), F.col("b") / F.lit(max(n0, 1))
    chosen = common.where(F.greatest(*rates) >= LEAST_LIFT * F.least(*rates)).where(F.col("z") >= min(LEAST_SHARE * n ** 0.5, (2 * math.log(max(common.count(), 2))) ** 0.5))
    terms = sorted(r["term"] for r in chosen.select("term").collect())  # words of EXAMPLES texts at most
    numbers = {t: i for i, t in enumerate(terms)}

    schema = "id long, terms array<int>, times array<int>"
    vectors = staged(named(docs).mapInArrow(_vectors(numbers), schema), "term-vectors")
    frequencies = np.zeros(len(terms))
    held = vectors.select("terms").mapInArrow(_frequencies(len(terms)), "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for term, count in held.collect():  # one row per indexed term
        frequencies[term] = count
    rows = examples.select("id", "text").mapInArrow(_vectors(numbers), schema).join(
        F.broadcast(examples.select("id", "toxic")), "id").select("id", "toxic", "terms", "times").collect()  # EXAMPLES at most
    model = Examples([tuple(r) for r in rows], frequencies, vectors.count(), joined)
    return vectors.mapInArrow(_scores(model), "id long, score double, evidence array<long>, cosines array<double>").select(
        F.col("id").alias(id_col), "score", "evidence", "cosines")
