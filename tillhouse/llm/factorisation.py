"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata.

A document's features are the hashed words it holds (weights by damped count, scaled to unit length), statistics of its
structure, and its declared length. The machine has a weight and a short vector for each feature;
pairs of features interact by the product of their vectors. The sum over all pairs is half of the
square of the sum less the sum of the squares, per factor, so scoring is linear in the features.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.text import fold, freed, map_texts, slices

#: Hash space of the words.
BUCKETS = 1 << 15
FACTORS = 8
#: Labelled documents the machine is fitted on at most.
SAMPLE = 6000
#: Gradient steps, documents in each, and their size.
STEPS = 2000
BATCH = 64
RATE = 0.12
DECAY = 1e-4
SEED = 7
#: From this score on a document counts as good.
GOOD = 0.3
#: Entries of a worker's cache of words; it is emptied when full.
CACHE = 150_000
STATISTICS = (
    "log words", "letters per word", "capitals", "digits", "marks", "marked words", "bare marks", "distinct words",
    "commonest word", "same as the word before", "distinct lines", "words per line", "log declared length",
)

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_ENDS = b".,;:!?'\"()-"


class Features:
    """Turns texts into hashed words with weights, and a row of statistics."""

    def __init__(self):
        self.cache: dict[bytes, int] = {}

    def bucket(self, word: bytes) -> int:
        if (found := self.cache.get(word)) is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = self.cache[word] = xxhash.xxh64_intdigest(word) % BUCKETS
        return found

    def __call__(self, text: bytes, declared: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = text.split()
        counts = Counter(words)
        n = max(1, len(words))
        buckets = np.fromiter(map(self.bucket, counts), np.int32, len(counts))
        weights = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
        if len(weights):
            weights /= np.sqrt((weights**2).sum())
        size = max(1, sum(map(len, words)))
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        less = lambda chars: (len(text) - len(text.translate(None, chars))) / size
        odd = sum(c for w, c in counts.items() if w[-1] in _MARKS and w[-1] not in _ENDS)
        bare = sum(c for w, c in counts.items() if not w.strip(_MARKS))
        repeated = sum(a == b for a, b in zip(words, words[1:], strict=False))
        commonest = max(counts.values(), default=0)
        statistics = [
            np.log1p(len(words)) / 10, size / n / 10, less(_UPPER), less(_DIGITS), less(_MARKS), odd / n, bare / n, len(counts) / n,
            commonest / n, repeated / n, len(set(lines)) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))) / 10,
            np.log1p(max(0, declared if declared is not None else len(text))) / 15,
        ]
        return buckets, weights, np.array(statistics, np.float32)


@dataclass
class Machine:
    """Weights of a factorisation machine; statistics are features behind the hashed words."""

    bias: float
    weight: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def features(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers and values of all rows behind one another, and where each row begins."""
        own = np.arange(BUCKETS, BUCKETS + len(STATISTICS), dtype=np.int32)
        index = np.concatenate([x for buckets, _, _ in rows for x in (buckets, own)])
        scaled = [np.clip((s - self.mean) / self.spread, -4, 4) / np.sqrt(len(STATISTICS)) for _, _, s in rows]
        value = np.concatenate([x for (_, weights, _), s in zip(rows, scaled, strict=True) for x in (weights, s)]).astype(np.float32)
        starts = np.cumsum([0, *[len(b) + len(own) for b, _, _ in rows[:-1]]])
        return index, value, starts

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score before the logistic curve, the sums of vectors per row, and the vectors times values."""
        scaled = self.vectors[index] * value[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(scaled**2, starts, axis=0)
        linear = np.add.reduceat(self.weight[index] * value, starts)
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1), sums, scaled

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.features(rows))[0].astype(float), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Logistic loss by stochastic gradients with a step size per weight (AdaGrad). Without rows every score is 0.5."""
    random = np.random.default_rng(SEED)
    total = BUCKETS + len(STATISTICS)
    statistics = np.array([s for _, _, s in rows], np.float32).reshape(len(rows), len(STATISTICS))
    machine = Machine(
        0.0,
        np.zeros(total, np.float32),
        random.normal(0, 0.05, (total, FACTORS)).astype(np.float32) if rows else np.zeros((total, FACTORS), np.float32),
        statistics.mean(axis=0) if rows else np.zeros(len(STATISTICS), np.float32),
        statistics.std(axis=0) + 1e-3 if rows else np.ones(len(STATISTICS), np.float32),
    )
    if not rows:
        return machine
    rate = min(0.99, max(0.01, float(labels.mean())))
    machine.bias = float(np.log(rate / (1 - rate)))
    seen_weight, seen_vectors, seen_bias = np.full(total, 1e-2, np.float32), np.full((total, FACTORS), 1e-2, np.float32), 1e-2
    per_pass = -(-len(rows) // BATCH)
    for _ in range(-(-STEPS // per_pass)):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            index, value, starts = machine.features([rows[i] for i in chosen])
            raw, sums, scaled = machine.raw(index, value, starts)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]).astype(np.float32) / len(chosen)
            own = np.repeat(np.arange(len(chosen)), np.diff([*starts, len(index)]))
            step = error[own] * value
            used, place = np.unique(index, return_inverse=True)
            for_weight = np.bincount(place, step, len(used)).astype(np.float32) + DECAY * machine.weight[used]
            pairs = step[:, None] * (sums[own] - scaled)
            order_by = np.argsort(place, kind="stable")
            for_vectors = np.add.reduceat(pairs[order_by], np.searchsorted(place[order_by], np.arange(len(used))), axis=0) + DECAY * machine.vectors[used]
            seen_weight[used] += for_weight**2
            seen_vectors[used] += for_vectors**2
            seen_bias += float(error.sum()) ** 2
            machine.weight[used] -= RATE * for_weight / np.sqrt(seen_weight[used])
            machine.vectors[used] -= RATE * for_vectors / np.sqrt(seen_vectors[used])
            machine.bias -= RATE * float(error.sum()) / float(np.sqrt(seen_bias))
    return machine


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most ``SAMPLE`` labelled documents for learning: ``text``, ``n_chars``, ``quality``.

    Labels count if id and quality are there and the id is not held out; of several for an id the lowest holds. The
    sample is the documents of smallest hash, chosen among the labels before any text is read; of several rows of an id
    that with the smallest text hash counts. Texts of any length are learned from whole.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold() != 0))
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = one.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE).withColumnRenamed("doc_id", "id")
    texts = docs.select("doc_id", "text", F.col("n_chars").cast("long").alias("n_chars"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "text", "n_chars", "quality")
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.hash("text"), "n_chars"))
    return rows.withColumn("_first", first).filter("_first = 1").drop("_first")


def learn(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit the machine on the sample. The workers make the features; the driver gets a few MB of them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            made = [features(t or b"", n) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([b.astype("<i4").tobytes() for b, _, _ in made], pa.binary()),
                    pa.array([w.astype("<f4").tobytes() for _, w, _ in made], pa.binary()),
                    pa.array([s.astype("<f4").tobytes() for _, _, s in made], pa.binary()),
                    batch.column("quality"),
                ],
                ["doc_id", "buckets", "weights", "statistics", "quality"],
            )

    chosen = sample(docs, labels).select("doc_id", F.col("text").cast("binary").alias("text"), "n_chars", F.col("quality").cast("int").alias("quality"))
    made = chosen.mapInArrow(each, "doc_id long, buckets binary, weights binary, statistics binary, quality int")
    got = made.toArrow().to_pylist()
    got.sort(key=lambda r: (r["doc_id"], r["buckets"], r["weights"], r["statistics"]))  # the same order whichever task came first
    rows = [(np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["weights"], "<f4"), np.frombuffer(r["statistics"], "<f4")) for r in got]
    return fit(rows, np.array([r["quality"] for r in got], np.float32))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row.

    Needs ``doc_id``, ``text`` and ``n_chars``. A null text is empty, a null ``n_chars`` is read from the text, a null id
    stays null (and held_out is null); repeated rows are scored each. An empty table gives no rows. No shuffle.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = [features(t or b"", n) for t, n in zip(batch.column("text").to_pylist(), batch.column("n_chars").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(machine.scores(rows), pa.float64())], ["doc_id", "score"])

    scored = map_texts(docs.withColumn("n_chars", F.col("n_chars").cast("long")), ["doc_id", "text", "n_chars"], "doc_id long, score double", each)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of ``docs`` that score as good, with all their columns."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in slices(batches):
            texts, declared = batch.column("text").to_pylist(), batch.column("n_chars").cast(pa.int64()).to_pylist()
            scores = machine.scores([features((t or "").encode(), n) for t, n in zip(texts, declared, strict=True)])
            yield batch.filter(pa.array(scores >= GOOD))

    return docs.mapInArrow(lambda it: freed(each(it)), docs.schema)
