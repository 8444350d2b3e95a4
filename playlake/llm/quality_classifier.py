"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of about 512 bytes. Each passage becomes a vector
of byte-class shares, hashed three-byte shares and a repetition measure. Gated
attention weights ``softmax(w . (tanh(V h) * sigmoid(U h)))`` combine the vectors
of a document; a logistic layer scores the combination. Only document labels
train the weights, by full-batch Adam on the driver over a bounded sample of labelled
rows: at most ``SAMPLE``, and no more than have ``TRAIN_BYTES`` of text together, each
with all of its passages. Scoring reads every passage of every document.

Defined cases: null and empty texts are one passage of zeros; repeated rows score
alike, each in a row of its own; without labels of both kinds the score is the
share of good labels (0.5 without any); conflicting labels of one id count by
their mean; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playlake.llm.rows import map_batches, remainder, small_batches, texts

PASSAGE = 512
BUCKETS = 64
HIDDEN = 16
SAMPLE = 4000
TRAIN_BYTES = 48 << 20  # some 98,000 passages, 30 MB of vectors
ROUNDS = 400
DECAY = 1e-4
THRESHOLD = 0.3
FOLDS = 5
BLOCK_BYTES = 4 << 20

_CLASSES = 9
WIDTH = _CLASSES + 2 + BUCKETS


def _byte_classes() -> np.ndarray:
    """Lower, upper, digit, space, line end, sentence mark, symbol, other ASCII, beyond ASCII."""
    table = np.full(256, 7, np.int64)
    table[128:] = 8
    for number, members in enumerate(
        [
            bytes(range(97, 123)),
            bytes(range(65, 91)),
            b"0123456789",
            b" \t\r\x0b\x0c",
            b"\n",
            b".,;:?!'\"()-",
            b"#*$%&|<>@^_~=+/\\{}[]`",
        ]
    ):
        table[list(members)] = number
    return table


_TABLE = _byte_classes()


def _slices(found: list[bytes]) -> tuple[list[bytes], list[int]]:
    """Texts cut into stretches of whole passages that fit into memory, and their documents."""
    parts, owners = [], []
    for number, text in enumerate(found):
        count = max(1, len(text) // PASSAGE)
        step = max(1, BLOCK_BYTES // PASSAGE)
        for first in range(0, count, step):
            end = len(text) if first + step >= count else (first + step) * PASSAGE
            parts.append(text[first * PASSAGE : end])
            owners.append(number)
    return parts, owners


def _encode_block(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors of some stretches, and passages per stretch."""
    sizes = np.array([len(p) for p in parts], np.int64)
    counts = np.maximum(1, sizes // PASSAGE)
    total = int(counts.sum())
    data = np.frombuffer(b"".join(parts), np.uint8)
    first = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), sizes)
    inside = np.arange(len(data)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    passage = first + np.minimum(inside // PASSAGE, np.repeat(counts - 1, sizes))
    lengths = np.bincount(passage, minlength=total).astype(np.float32)
    per = np.maximum(lengths, 1)[:, None]
    classes = np.bincount(passage * _CLASSES + _TABLE[data], minlength=total * _CLASSES)
    classes = classes.reshape(total, _CLASSES) / per
    grams = np.zeros((total, BUCKETS), np.float32)
    repeats = np.zeros(total, np.float32)
    if len(data) > 3:
        wide = data.astype(np.uint32)
        mixed = (wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16) * np.uint32(2654435761)
        hashed = (mixed >> np.uint32(26)).astype(np.int64)
        grams = np.bincount(passage[:-3] * BUCKETS + hashed, minlength=total * BUCKETS)
        grams = np.sqrt(grams.reshape(total, BUCKETS) / per)
        longer = (mixed ^ wide[3:] * np.uint32(40503)) * np.uint32(2246822519)
        spread = np.bincount(passage[:-3] * 256 + (longer >> np.uint32(24)).astype(np.int64), minlength=total * 256)
        repeats = (spread.reshape(total, 256).astype(np.float32) ** 2).sum(1) / per[:, 0] ** 2
    vectors = np.concatenate([classes, np.log1p(lengths)[:, None], np.sqrt(repeats)[:, None], grams], axis=1)
    return vectors.astype(np.float32), counts


def encode(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(passage vectors, number of passages of each text)."""
    parts, owners = _slices(found)
    vectors, counts = [], np.zeros(len(found), np.int64)
    start = 0
    while start < len(parts):
        end, size = start + 1, len(parts[start])
        while end < len(parts) and size + len(parts[end]) <= BLOCK_BYTES:
            size += len(parts[end])
            end += 1
        block, number = _encode_block(parts[start:end])
        vectors.append(block)
        np.add.at(counts, owners[start:end], number)
        start = end
    return np.concatenate(vectors) if vectors else np.zeros((0, WIDTH), np.float32), counts


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def scores(self, vectors: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(counts), self.constant)
        scaled = (vectors - self.mean) / self.spread
        return _forward(self.weights, scaled, _starts(counts), counts)["score"]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w, h, starts, counts) -> dict:
    gate, squashed = _sigmoid(h @ w["U"]), np.tanh(h @ w["V"])
    raw = (gate * squashed) @ w["w"]
    raw = np.exp(raw - np.repeat(np.maximum.reduceat(raw, starts), counts))
    attention = raw / np.repeat(np.add.reduceat(raw, starts), counts)
    bag = np.add.reduceat(attention[:, None] * h, starts, axis=0)
    return {
        "gate": gate, "squashed": squashed, "attention": attention, "bag": bag,
        "score": _sigmoid(bag @ w["c"] + w["b"][0]),
    }


def _gradient(w, h, starts, counts, target) -> dict[str, np.ndarray]:
    """Of the mean log loss, and of DECAY / 2 times the squared weights (all but ``b``)."""
    f = _forward(w, h, starts, counts)
    error = (f["score"] - target) / len(target)
    to_h = np.repeat(error, counts) * (h @ w["c"])
    to_raw = f["attention"] * (to_h - np.repeat(np.add.reduceat(f["attention"] * to_h, starts), counts))
    to_gated = to_raw[:, None] * w["w"]
    return {
        "c": f["bag"].T @ error + DECAY * w["c"],
        "b": np.array([error.sum()]),
        "w": (f["gate"] * f["squashed"]).T @ to_raw + DECAY * w["w"],
        "V": h.T @ (to_gated * f["gate"] * (1 - f["squashed"] ** 2)) + DECAY * w["V"],
        "U": h.T @ (to_gated * f["squashed"] * f["gate"] * (1 - f["gate"])) + DECAY * w["U"],
    }


def fit(vectors: np.ndarray, counts: np.ndarray, target: np.ndarray) -> Model:
    """Gated attention and logistic layer by Adam on the mean log loss."""
    if not len(counts) or target.min() == target.max():
        return Model(np.zeros(WIDTH), np.ones(WIDTH), {}, float(target.mean()) if len(counts) else 0.5)
    mean, spread = vectors.mean(0), vectors.std(0) + 1e-3
    h, starts = ((vectors - mean) / spread).astype(np.float64), _starts(counts)
    rng = np.random.default_rng(7)
    w = {
        "V": rng.normal(0, 0.1, (WIDTH, HIDDEN)),
        "U": rng.normal(0, 0.1, (WIDTH, HIDDEN)),
        "w": rng.normal(0, 0.1, HIDDEN),
        "c": np.zeros(WIDTH),
        "b": np.zeros(1),
    }
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, ROUNDS + 1):
        grad = _gradient(w, h, starts, counts, target)
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w[k] -= 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, spread, w)


def _train(documents: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of labelled documents outside the held-out fold."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    order = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", FOLDS) != 0))
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("target"))
        .orderBy(order, "doc_id")
        .limit(SAMPLE)
    )
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id")  # SAMPLE rows at most
    # An id may have several texts: the same bound again, and that of bytes. Copies train once.
    rows = rows.withColumn("which", F.xxhash64("text"))
    sized = rows.groupBy("doc_id", "which").agg(F.max(F.octet_length("text")).alias("size"))
    drawn, total = [], 0
    for row in sized.orderBy(order, "doc_id", "which").limit(SAMPLE).collect():
        if total + row["size"] <= TRAIN_BYTES:
            total += row["size"]
            drawn.append((row["doc_id"], row["which"]))
    picks = documents.sparkSession.createDataFrame(drawn, f"doc_id {kind}, which long")
    rows = rows.join(F.broadcast(picks), ["doc_id", "which"]).dropDuplicates(["doc_id", "which"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, counts = encode(texts(batch))
        ends = np.cumsum(counts)
        bags = [vectors[end - count : end].tobytes() for end, count in zip(ends, counts, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("target"), pa.array(bags, pa.binary())], ["doc_id", "target", "bag"]
        )

    bags = map_batches(rows.select("doc_id", "target", "text"), work, f"doc_id {kind}, target double, bag binary")
    found = sorted(bags.collect(), key=lambda row: (repr(row.doc_id), row.bag))
    blocks = [np.frombuffer(row.bag, np.float32).reshape(-1, WIDTH) for row in found]
    vectors = np.concatenate(blocks) if blocks else np.zeros((0, WIDTH), np.float32)
    return fit(vectors, np.array([len(b) for b in blocks], np.int64), np.array([r.target for r in found], np.float64))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every document."""
    spark = documents.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(_train(documents, labels))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, counts = encode(texts(batch))
        scores = sent.value.scores(vectors, counts)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores.astype(np.float64)), pa.array(counts)],
            ["doc_id", "score", "n_passages"],
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, work, f"doc_id {kind}, score double, n_passages long").select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_passages",
    )
