"""Quality classifier: attention-based multiple-instance learning over the passages of a text.

Every passage is encoded, gated attention weighs the passages, and the weighed sum is scored. Only
document labels train it: the weights of the passages are learned through them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import give_back, text_or_empty

#: Bytes of a passage; the last may be shorter.
PASSAGE = 1024
#: Labelled documents that the fit may use, those with the lowest hashes of their ids; and the passages that
#: these may have in all, 2 bytes a feature on the driver (24 MB). A document of over a hundredth of the
#: passages is scored like any other but not learned from.
SAMPLE, SAMPLE_PASSAGES = 6_000, 24_000
HIDDEN, GATE, EPOCHS, BATCH, RATE, SEED = 24, 12, 30, 64, 0.004, 5
#: Rows that count as labelled 1 from this score on.
ACCEPT = 0.3

#: Classes of bytes; all bytes of characters beyond ASCII are one class.
_GROUPS = [
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\t\n\r\x0b\x0c", ".", ",", "!", "?", "|",
    "$", "#", "%", "&", "*", "()[]{}<>", "\"'`", ":;", "-_/\\", "@^~+=",
]
_CLASSES = len(_GROUPS) + 2
_CLASS = np.full(256, _CLASSES - 1, np.int64)
_CLASS[128:] = _CLASSES - 2
for _i, _g in enumerate(_GROUPS):
    _CLASS[np.frombuffer(_g.encode(), np.uint8)] = _i
WIDTH = _CLASSES * _CLASSES + 3


def encode(text: bytes) -> np.ndarray:
    """A row for each passage: square roots of the shares of pairs of byte classes, then how much of the
    whole text is repeated lines, its share of distinct words, and its length. An empty text is one row."""
    data = np.frombuffer(text, np.uint8)
    passages = max(1, -(-len(data) // PASSAGE))
    out = np.zeros((passages, WIDTH), np.float32)
    if len(data) > 1:
        codes = _CLASS[data]
        pairs = codes[:-1] * _CLASSES + codes[1:]
        pairs += np.arange(len(pairs)) // PASSAGE * (_CLASSES * _CLASSES)
        counts = np.bincount(pairs, minlength=passages * _CLASSES * _CLASSES).reshape(passages, -1)
        out[:, :-3] = np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))
    lines, words = text.split(b"\n"), text.split()
    out[:, -3] = 1 - len(set(lines)) / len(lines)
    out[:, -2] = len(set(words)) / max(1, len(words))
    out[:, -1] = np.log1p(len(words)) / 8
    return out


@dataclass
class Model:
    """mean, scale: of the passages' rows; prior: the score where nothing could be learned."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    w: dict[str, np.ndarray] | None = None

    def scores(self, passages: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.w is None:
            return np.full(len(starts), self.prior)
        return _forward(self.w, (passages - self.mean) / self.scale, starts)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """starts: the first passage of each document. a: a document's attention, which sums to 1."""
    bag = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
    h = np.tanh(x @ w["E"] + w["e"])
    t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    logit = (t * s) @ w["a"]
    a = np.exp(logit - np.maximum.reduceat(logit, starts)[bag])
    a /= np.add.reduceat(a, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"bag": bag, "h": h, "t": t, "s": s, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["d"][0])}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, starts)
    bag, h, t, s, a = f["bag"], f["h"], f["t"], f["s"], f["a"]
    dz = (f["p"] - y)[:, None] / len(y) * w["c"]
    da = (dz[bag] * h).sum(axis=1)
    dlogit = a * (da - np.add.reduceat(a * da, starts)[bag])
    dt, ds = dlogit[:, None] * w["a"] * s * (1 - t * t), dlogit[:, None] * w["a"] * t * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
    return {
        "E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "a": (t * s).T @ dlogit,
        "c": f["z"].T @ (f["p"] - y) / len(y), "d": np.array([(f["p"] - y).mean()]),
    }


def train(passages: list[np.ndarray], labels: np.ndarray) -> Model:
    """Adam on the mean log loss; without both labels the score is the smoothed share of ones.

    passages: an array a document, of any float type; only a batch at a time is widened and scaled."""
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(prior)
    count, total, squares = 0, np.zeros(WIDTH), np.zeros(WIDTH)
    for p in passages:
        wide = p.astype(np.float64)
        count, total, squares = count + len(p), total + wide.sum(axis=0), squares + (wide * wide).sum(axis=0)
    mean = (total / count).astype(np.float32)
    scale = (np.sqrt(np.maximum(0, squares / count - (total / count) ** 2)) + 0.02).astype(np.float32)
    draw = np.random.default_rng(SEED)
    w = {
        "E": draw.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), "e": np.zeros(HIDDEN),
        "V": draw.normal(0, 0.3, (HIDDEN, GATE)), "U": draw.normal(0, 0.3, (HIDDEN, GATE)), "a": draw.normal(0, 0.3, GATE),
        "c": np.zeros(HIDDEN), "d": np.array([np.log(prior / (1 - prior))]),
    }
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            starts = np.cumsum([0] + [len(passages[i]) for i in chosen[:-1]])
            x = (np.concatenate([passages[i] for i in chosen]).astype(np.float32) - mean) / scale
            grads = _gradients(w, x, starts, labels[chosen].astype(float))
            step += 1
            for k, g in grads.items():
                g = g + (1e-4 * w[k] if k in "EVU" else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(prior, mean, scale, w)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels no fit may see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _share(most: int) -> int:
    """Passages that one document may put into the fit: a hundredth of all."""
    return max(1, most // 100)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, most: int) -> tuple[DataFrame, DataFrame]:
    """id, label of the labelled documents to learn from; and id, text of docs' rows."""
    seen = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label is not null").filter(~held_out(F.col("id")))
    chosen = seen.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"))
    passages = F.least(F.lit(_share(most)), F.greatest(F.lit(1), F.ceil(F.length("text") / PASSAGE)))
    # At most sample rows: a document's passages are those of all rows with its id.
    sizes = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.sum(passages).alias("p"))
    upto = Window.orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    return sizes.withColumn("upto", F.sum("p").over(upto)).filter(F.col("upto") <= most).select("id", "label"), texts


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, most: int = SAMPLE_PASSAGES
) -> Model:
    """Learns from at most sample labelled documents that aren't held out, with at most `most` passages in all; these
    go to the driver. Of a document with over a hundredth of them so many are taken, at even distances over the whole
    text, each with the figures of the whole text. A repeated id counts as often as it occurs; no labels, or one only,
    give their share as the score."""
    chosen, texts = _sample(docs, labels, id_col, text_col, label_col, sample, most)
    share = _share(most)

    def spread(coded: np.ndarray) -> np.ndarray:
        return coded if len(coded) <= share else coded[np.linspace(0, len(coded) - 1, share).astype(int)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [spread(encode(t.as_py())).astype(np.float16).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(coded, pa.binary())], ["id", "label", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    coded = texts.join(F.broadcast(chosen), "id").select("id", "label", "text").mapInArrow(rows, f"id {kind}, label int, x binary")
    found = coded.toArrow()
    order = pc.sort_indices(found, [("id", "ascending"), ("x", "ascending")]).to_pylist()
    passages = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, WIDTH) for x in found["x"]]
    return train([passages[i] for i in order], found["label"].to_numpy()[order])


def score(model: Model, text: Column) -> Column:
    """The model's score of each whole text, 0 to 1; null counts as empty."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for at in range(0, len(texts), 256):
                coded = [encode(t.encode()) for t in texts.iloc[at : at + 256]]
                starts = np.cumsum([0] + [len(c) for c in coded[:-1]])
                out.append(model.scores(np.concatenate(coded), starts))
            yield pd.Series(np.concatenate(out) if out else np.empty(0))
        give_back()

    return scores(F.coalesce(text, F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """id, held_out, score and predicted for each row of docs, whole texts scored.

    Null and empty texts are one empty passage and get its score; a null id isn't held out. Rows
    repeat as they come. Without labels every score is 0.5, so all rows are accepted; an empty table
    gives no rows. Columns but id and text aren't read.
    """
    model = fit(docs, labels, id_col, text_col)
    scored = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= accept).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """docs without the rows that classify() rejects; columns stay as they are.

    A null text is judged as an empty one, repeated rows alike, rows without an id as any other; without labels all
    rows stay; an empty table gives no rows."""
    model = fit(docs, labels, id_col, text_col)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return row.withColumn("score", score(model, F.col(f"row.`{text_col}`"))).filter(F.col("score") >= accept).select("row.*")
