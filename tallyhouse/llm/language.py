"""Operator 9: language of a text by a byte convolutional network.

A text is read as UTF-8 bytes in windows of fixed length.  Bytes are embedded, filters of several widths slide over the
window, each filter keeps its maximum, and a softmax over the languages follows.  The network is trained in numpy, on the
driver, by Adam on windows of a bounded sample of labelled documents (``PER_LABEL`` of each language, ``TRAIN_WINDOWS`` windows
each); prediction covers every window of every whole text, in batches, and averages the windows' probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm import bytetext
from tallyhouse.llm.folds import in_fold

FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
WINDOW = 256
EMBEDDING, WIDTHS, FILTERS = 8, (2, 3, 4), 12
#: Bounds of the training sample: documents of each language, windows of each.
PER_LABEL, TRAIN_WINDOWS = 1200, 3
EPOCHS, BATCH, RATE, SEED = 12, 128, 0.01, 7
#: Windows of one batch of the network.
PREDICT_WINDOWS = 128


class ByteConvNet:
    """Embedding, filters of several widths, maximum over the window, softmax."""

    def __init__(self, labels: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        reach, n = max(WIDTHS), len(WIDTHS) * FILTERS
        self.labels = labels
        self.taps = np.zeros((reach * EMBEDDING, n), np.float32)  # a narrow filter has zeros in its last taps
        for k, width in enumerate(WIDTHS):
            self.taps[: width * EMBEDDING, k * FILTERS : (k + 1) * FILTERS] = 1
        self.weights = {
            "embedding": rng.normal(0, 0.5, (256, EMBEDDING)),
            "filters": rng.normal(0, 1 / np.sqrt(reach * EMBEDDING), self.taps.shape) * self.taps,
            "bias": np.zeros(n),
            "out": rng.normal(0, 1 / np.sqrt(n), (n, len(labels))),
            "out_bias": np.zeros(len(labels)),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def _patches(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, taps): the embedded bytes under the filters at each position."""
        w = self.weights
        embedded = w["embedding"][windows].reshape(len(windows), -1)
        reach = max(WIDTHS)
        positions = windows.shape[1] - reach + 1
        step = embedded.strides[1] * EMBEDDING
        return np.lib.stride_tricks.as_strided(
            embedded, (len(windows), positions, reach * EMBEDDING), (embedded.strides[0], step, embedded.strides[1]), writeable=False
        )

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest activation of each filter, and where."""
        patches = self._patches(windows)
        flat = np.ascontiguousarray(patches).reshape(-1, patches.shape[2]) @ self.weights["filters"]
        flat = flat.reshape(patches.shape[0], patches.shape[1], -1)
        at = flat.argmax(axis=1)
        best = np.take_along_axis(flat, at[:, None, :], axis=1)[:, 0, :] + self.weights["bias"]
        return np.maximum(best, 0), at

    def strongest(self, windows: np.ndarray) -> np.ndarray:
        patches = self._patches(windows)
        flat = np.ascontiguousarray(patches).reshape(-1, patches.shape[2]) @ self.weights["filters"]
        return np.maximum(flat.reshape(patches.shape[0], patches.shape[1], -1).max(axis=1) + self.weights["bias"], 0)

    def _softmax(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.weights["out"] + self.weights["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [self._softmax(self.strongest(windows[k : k + PREDICT_WINDOWS])) for k in range(0, len(windows), PREDICT_WINDOWS)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def gradients(self, windows: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        hidden, at = self.pooled(windows)
        error = self._softmax(hidden)
        error[np.arange(len(target)), target] -= 1
        error *= weight[:, None] / weight.sum()
        to_hidden = (error @ self.weights["out"].T) * (hidden > 0)
        rows, n = np.arange(len(windows))[:, None], hidden.shape[1]
        reach = max(WIDTHS)
        filters = np.zeros_like(self.weights["filters"])
        embedding = np.zeros_like(self.weights["embedding"])
        for tap in range(reach):  # the maximum passes the gradient to the bytes under it alone
            under = windows[rows, at + tap]
            here = slice(tap * EMBEDDING, (tap + 1) * EMBEDDING)
            filters[here] = np.einsum("bfe,bf->ef", self.weights["embedding"][under], to_hidden)
            flow = to_hidden[:, :, None] * self.weights["filters"][here].T[None]
            np.add.at(embedding, under.reshape(-1), flow.reshape(-1, EMBEDDING))
        return {
            "embedding": embedding, "filters": filters * self.taps, "bias": to_hidden.sum(axis=0),
            "out": hidden.T @ error, "out_bias": error.sum(axis=0),
        }

    def train(self, windows: np.ndarray, target: np.ndarray) -> ByteConvNet:
        """Adam over shuffled batches; each language weighs the same."""
        rng = np.random.default_rng(SEED)
        weight = (1 / np.maximum(np.bincount(target, minlength=len(self.labels)), 1))[target].astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step, steps = 0, EPOCHS * -(-len(windows) // BATCH)
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for k in range(0, len(order), BATCH):
                some = order[k : k + BATCH]
                step += 1
                rate = RATE * (1 - step / (steps + 1))
                for name, g in self.gradients(windows[some], target[some], weight[some]).items():
                    first[name] = 0.9 * first[name] + 0.1 * g
                    second[name] = 0.999 * second[name] + 0.001 * g * g
                    m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.999**step)
                    self.weights[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        return self


def byte_windows(run: bytetext.Run) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bytes) of consecutive windows over whole texts, the last of a text filled up with zero bytes."""
    lengths = np.diff(run.offsets)
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = run.offsets[owner] + place * WINDOW
    at = start[:, None] + np.arange(WINDOW)
    inside = at < run.offsets[owner + 1][:, None]
    return owner, np.where(inside, run.data[np.minimum(at, max(len(run.data) - 1, 0))], 0) if len(owner) else np.zeros((0, WINDOW), np.uint8)


def training_windows(docs: DataFrame, label: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and their language numbers, from a bounded sample outside the held-out fold.

    Texts are taken by the hash of their id and themselves; their windows lie evenly over the whole text.  Equal rows count
    once, so the bound holds however often an id or a text is repeated.
    """
    known = docs.filter(F.col(label).isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~in_fold("doc_id", FOLDS, HELD_OUT))
    known = known.select(F.col(label).alias("label"), "text", F.xxhash64("doc_id", "text").alias("place"))
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # a row a language
    if not sizes:
        return [], np.zeros((0, WINDOW), np.uint8), np.zeros(0, int)
    # places under a bound that about twice the sample meets, so that few rows are ordered
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 2 * PER_LABEL / n))]), F.col("label"))
    near = known.filter(F.col("place") / 2.0**64 + 0.5 <= share).select("label", "place").distinct()
    chosen = near.withColumn("number", F.row_number().over(Window.partitionBy("label").orderBy("place"))).filter(F.col("number") <= PER_LABEL)
    chosen = chosen.select("label", "place")  # at most PER_LABEL a language
    schema = "label string, window binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(0).to_pylist()
            out_labels, out = [], []
            for r in bytetext.runs(batch.column(1)):
                owner, windows = byte_windows(r)
                for text in np.unique(owner):
                    mine = np.flatnonzero(owner == text)
                    for k in np.unique(np.linspace(0, len(mine) - 1, TRAIN_WINDOWS).astype(int)):
                        out_labels.append(labels[r.first + text])
                        out.append(windows[mine[k]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_labels, pa.string()), pa.array(out, pa.binary())], names=["label", "window"])

    sample = known.join(F.broadcast(chosen), ["label", "place"], "left_semi").select("label", "text").distinct()
    rows = sample.mapInArrow(cut, schema)
    got = sorted((r.label, bytes(r.window)) for r in rows.toLocalIterator())
    labels = sorted({a for a, _ in got})
    windows = np.frombuffer(b"".join(b for _, b in got), np.uint8).reshape(-1, WINDOW)
    return labels, windows, np.array([labels.index(a) for a, _ in got], int)


def train_network(docs: DataFrame, label: str = "lang") -> ByteConvNet | None:
    """The trained network; None where no labelled text is at hand."""
    labels, windows, target = training_windows(docs, label)
    return ByteConvNet(labels).train(windows, target) if labels else None


def predict_languages(
    docs: DataFrame, network: ByteConvNet | None, text: str = "text", language: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Adds the language and its score for every whole text, replacing columns of those names.

    A null text, one without a letter, and any text when no network could be trained is ``und`` with score 0.  Repeated rows
    stay; an empty table gives an empty one.
    """
    out = docs.drop(language, score)
    schema = T.StructType([*out.schema.fields, T.StructField(language, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            for r in bytetext.runs(column):
                part = batch.slice(r.first, r.last - r.first)
                speaks = np.array([any(map(str.isalpha, v or "")) for v in column[r.first : r.last].to_pylist()], bool)
                names, scores = np.full(len(part), UNKNOWN, object), np.zeros(len(part))
                if network is not None:
                    owner, windows = byte_windows(r)
                    filled = (windows != 0).sum(axis=1)
                    total = np.zeros((len(part), len(network.labels)))
                    np.add.at(total, owner, network.probabilities(windows) * filled[:, None])
                    total /= np.maximum(np.bincount(owner, filled, len(part)), 1)[:, None]
                    best = total.argmax(axis=1)
                    names[speaks] = np.array(network.labels, object)[best[speaks]]
                    scores[speaks] = np.clip(total.max(axis=1)[speaks], 0, 1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string()), pa.array(scores)], names=schema.fieldNames())

    return out.mapInArrow(run, schema)


def language_scores(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score.

    A null text, or one without a letter, is ``und`` with score 0, as is any text where no row teaches a language.  Repeated
    rows stay, rows without an id are not held out and teach nothing, and an empty table gives an empty one.
    """
    network = train_network(docs)
    rows = predict_languages(docs.select("doc_id", "text"), network)
    return rows.select("doc_id", in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score")
