"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features are hashed one- and two-grams of a text's words, both as they are and as shapes (letters as a or A,
digits as 0, runs as one), with a word that repeats the one before it as a gram of its own. Counts are
scaled to length one, so that texts of any length score alike. Training runs in one task over a bounded
sample of the labelled rows (SAMPLE of them, those with the smallest hash of their id); scoring is a sparse
dot product, row by row, over everything. Ids without a document take no place in the sample; of an id's
several documents one is learnt from.

Whole texts are read. Null and empty texts have the constant feature only. A row without an id isn't held
out and isn't trained on. If an id has several labels, the least counts. Without any label each score
is a half. Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import unique_name, whole_text

BITS = 18
SAMPLE = 8_000
EPOCHS = 4
RATE = 1.0
SMOOTHING = 1.0
L1 = 1e-4
L2 = 1e-4
CUTOFF = 0.7
MEMO = 400_000
BIAS = 0
_MIX = np.uint64(0x9E3779B97F4A7C15)
_REPEATED = np.uint64(0x5851F42D4C957F2D)


def shape(word: str) -> str:
    out = []
    for c in word:
        kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class Grams:
    """Sparse features of texts; remembers the hashes of words."""

    def __init__(self, bits: int = BITS, memo: int = MEMO):
        self.shift = np.uint64(64 - bits)
        self.memo: dict[str, int] = {}
        self.limit = memo

    def _hash(self, word: str) -> int:
        own = xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"))
        return own << 32 | xxhash.xxh32_intdigest(shape(word).encode("utf-8", "surrogatepass"))

    def _slots(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        return ((hashes ^ np.uint64(kind * 0x2545F491)) * _MIX) >> self.shift

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Slots and their values, the constant's slot first."""
        words = text.split()
        memo = self.memo
        if len(memo) > self.limit:
            memo.clear()
        for word in words:
            if word not in memo:
                memo[word] = self._hash(word)
        both = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        pair = (word[:-1] * _MIX) ^ word[1:]
        pair[word[:-1] == word[1:]] = _REPEATED
        forms = (form[:-1] * _MIX) ^ form[1:]
        kinds = [self._slots(h, k + 1) for k, h in enumerate((word, pair, form, forms))]
        slots, counts = np.unique(np.concatenate(kinds).astype(np.int64), return_counts=True)
        values = counts / max(1.0, np.sqrt((counts.astype(float) ** 2).sum()))
        return np.append(BIAS, slots), np.append(1.0, values)


class FollowTheLeader:
    """Per-coordinate FTRL-proximal for the logistic loss."""

    def __init__(self, size: int, rate: float = RATE, smoothing: float = SMOOTHING, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.rate, self.smoothing, self.l1, self.l2 = rate, smoothing, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        pull = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, pull / ((self.smoothing + np.sqrt(n)) / self.rate + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One example; `at` has no slot twice."""
        w = self.weights(at)
        gradient = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        grown = self.n[at] + gradient**2
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.rate * w
        self.n[at] = grown


def merged(slots: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same vector without a slot twice."""
    own, place = np.unique(slots, return_inverse=True)
    return own, np.bincount(place, values)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, bits: int = BITS, epochs: int = EPOCHS,
) -> np.ndarray:
    """The weights. Only rows that aren't held out are learnt from."""
    known = labels.select(F.col(doc_id).alias("_own"), F.col(label).alias("_label"))
    known = known.filter(F.col("_own").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_own")))
    known = known.groupBy("_own").agg(F.min("_label").alias("_label"))
    texts = docs.select(F.col(doc_id).alias("_id"), whole_text(text).alias("_text"))
    known = known.join(texts.select("_id").distinct(), F.col("_id") == F.col("_own"), "left_semi")
    order = F.xxhash64("_own")
    chosen = known.orderBy(order, "_own").limit(sample)
    # At most `sample` rows of two numbers, whatever the size of the tables.
    rows = texts.join(F.broadcast(chosen), F.col("_id") == F.col("_own"))
    # One row an id, chosen before the shuffle.
    one = F.min(F.struct(F.xxhash64("_text").alias("hash"), F.col("_text").alias("text"))).alias("_one")
    rows = rows.groupBy("_own", "_label").agg(one).select("_own", "_label", F.col("_one.text").alias("_text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(bits)
        for batch in batches:
            found = [merged(*grams.features(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(batch.column(1).cast(pa.int32())),
                    pa.array([s for s, _ in found], pa.list_(pa.int64())),
                    pa.array([v for _, v in found], pa.list_(pa.float64())),
                ],
                ["id", "label", "slots", "values"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            label_of = batch.column("label").to_pylist()
            for i in range(batch.num_rows):
                pair = (batch.column(c)[i].values.to_numpy() for c in ("slots", "values"))
                examples.append((*pair, label_of[i]))
        model = FollowTheLeader(1 << bits)
        for _ in range(epochs):
            for slots, values, label_ in examples:
                model.learn(slots, values, label_)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights()], pa.list_(pa.float64()))], ["weights"])

    made = rows.mapInArrow(vectors, "id bigint, label int, slots array<bigint>, values array<double>")
    made = made.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id", "label", "slots")
    found = made.mapInArrow(fit, "weights array<double>").first()
    # Without a row there may be no task.
    return np.zeros(1 << bits) if found is None else np.array(found[0])


def score_column(weights):
    """A column function from text to its score; `weights` is a broadcast."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = weights.value
        grams = Grams(int(len(own)).bit_length() - 1)
        for texts in batches:
            sums = []
            for text in texts.to_pylist():
                slots, values = grams.features(text)
                sums.append(own[slots] @ values)
            yield pa.array(1.0 / (1.0 + np.exp(-np.array(sums))), pa.float64())

    return score


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text))
    found = docs.select(F.col(doc_id).alias("doc_id"), score_column(weights)(whole_text(text)).alias("score"))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that the classifier predicts to be good."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text))
    score = unique_name(docs, "_score")
    scored = docs.withColumn(score, score_column(weights)(whole_text(text)))
    return scored.filter(F.col(score) >= CUTOFF).select(*docs.columns)
