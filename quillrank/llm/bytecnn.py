"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.shared import chunks
from quillrank.llm.training import Adam, labelled_sample, sigmoid

CHUNK = 512            # bytes of a chunk
OVERLAP = 64           # bytes a chunk shares with the next
WIDTH = 8              # bytes a filter sees
FILTERS = 16
ECHO_REACH = range(3, 33)   # distances at which a repetition is noticed
ECHO_RUN = 8                # bytes that must repeat
THRESHOLD = 0.3
TRAIN_ROWS = 5000           # bound of the training sample
TRAIN_MAX_CHARS = 20_000
EPOCHS = 8
MIN_STEPS = 300        # small samples are passed more often
BATCH = 64
_PAD = 512                  # symbol behind the end of a text
_BLOCK = 128                # chunks convolved at once


def chunk_symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, owner)``: one row of CHUNK symbols per chunk, and the text each belongs to.
    Chunks cover the whole text; an empty text has one chunk of padding. A symbol is the byte
    value, plus 256 where the last ECHO_RUN bytes repeat what stood at one of the distances of
    ECHO_REACH before: filters can then tell running text from repetition."""
    rows, owner = [], []
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        symbols = data.astype(np.uint16)
        symbols[_echoes(data)] += 256
        for start in range(0, max(1, len(data) - OVERLAP), CHUNK - OVERLAP):
            row = np.full(CHUNK, _PAD, dtype=np.uint16)
            part = symbols[start:start + CHUNK]
            row[:len(part)] = part
            rows.append(row)
            owner.append(i)
    return np.array(rows, dtype=np.uint16).reshape(-1, CHUNK), np.array(owner, dtype=np.int64)


def _echoes(data: np.ndarray) -> np.ndarray:
    echo = np.zeros(len(data), dtype=bool)
    for distance in ECHO_REACH:
        equal = data[distance:] == data[:-distance]
        size = 1
        while size < ECHO_RUN and len(equal) > size:  # runs of 2, 4, 8 equal bytes
            equal = equal[size:] & equal[:-size]
            size *= 2
        if size >= ECHO_RUN and len(equal):
            echo[len(data) - len(equal):] |= equal
    return echo


class ByteCnn:
    """Filters over WIDTH symbols, maximum over a chunk, mean and maximum over the chunks of a
    text, one logistic unit. The first layer is a table of symbol by place in the filter, as a
    filter over one-hot bytes is a sum of table rows."""

    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.weights = {
            "byte": draw.normal(0, 0.1, (WIDTH, 257, FILTERS)).astype(np.float32),
            "echo": draw.normal(0, 0.1, (WIDTH, 2, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, dtype=np.float32),
            "out": draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "shift": np.zeros(1, dtype=np.float32),
        }

    def _table(self) -> np.ndarray:
        byte, echo = self.weights["byte"], self.weights["echo"]
        plain = byte[:, :256] + echo[:, :1]
        return np.concatenate(
            [plain, byte[:, :256] + echo[:, 1:], byte[:, 256:] + echo[:, :1]], axis=1
        )

    def _pool(self, symbols: np.ndarray, want_places: bool = False):
        """Largest response of each filter in each chunk, and where it stands."""
        table, places = self._table(), None
        n = CHUNK - WIDTH + 1
        top = np.empty((len(symbols), FILTERS), dtype=np.float32)
        if want_places:
            places = np.empty((len(symbols), FILTERS), dtype=np.int64)
        for at in range(0, len(symbols), _BLOCK):
            block = symbols[at:at + _BLOCK]
            response = np.take(table[0], block[:, :n], axis=0)
            for k in range(1, WIDTH):
                response += np.take(table[k], block[:, k:k + n], axis=0)
            if want_places:
                best = response.argmax(axis=1)
                places[at:at + _BLOCK] = best
                top[at:at + _BLOCK] = np.take_along_axis(response, best[:, None], axis=1)[:, 0]
            else:
                top[at:at + _BLOCK] = response.max(axis=1)
        return top + self.weights["bias"], places

    def _combine(self, pooled: np.ndarray, owner: np.ndarray):
        """Mean and maximum of the chunks of each text; owners are sorted, none is missing."""
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(first, len(owner)))
        mean = np.add.reduceat(pooled, first, axis=0) / sizes[:, None]
        return np.concatenate([mean, np.maximum.reduceat(pooled, first, axis=0)], axis=1), sizes

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        symbols, owner = chunk_symbols(texts)
        pooled = np.maximum(self._pool(symbols)[0], 0)
        vectors, _ = self._combine(pooled, owner)
        return sigmoid((vectors @ self.weights["out"] + self.weights["shift"]).astype(float))

    def gradients(self, symbols: np.ndarray, owner: np.ndarray, labels: np.ndarray):
        """Of the mean cross entropy; the maximum passes it to the winning places only."""
        response, places = self._pool(symbols, want_places=True)
        pooled = np.maximum(response, 0)
        vectors, sizes = self._combine(pooled, owner)
        out = self.weights["out"]
        error = (sigmoid(vectors @ out + self.weights["shift"]) - labels) / len(labels)
        at_pool = (error / sizes)[owner][:, None] * out[:FILTERS]
        winner = pooled == vectors[owner, FILTERS:]
        at_pool += winner * error[owner][:, None] * out[FILTERS:]
        at_pool *= response > 0
        result = {
            "byte": np.zeros_like(self.weights["byte"]),
            "echo": np.zeros_like(self.weights["echo"]),
            "bias": at_pool.sum(axis=0),
            "out": error @ vectors,
            "shift": np.array([error.sum()]),
        }
        rows, filters = np.nonzero(at_pool)
        value = at_pool[rows, filters]
        for k in range(WIDTH):
            seen = symbols[rows, places[rows, filters] + k].astype(np.int64)
            np.add.at(result["byte"][k], (np.where(seen == _PAD, 256, seen % 256), filters), value)
            np.add.at(result["echo"][k], (((seen >= 256) & (seen < _PAD)).astype(int), filters),
                      value)
        return result


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
          text: str = "text", rows: int = TRAIN_ROWS) -> ByteCnn:
    """A network fitted on a bounded sample of the labelled documents (``rows`` at most, in
    expectation; texts up to TRAIN_MAX_CHARS). Without any labelled row the network stays
    untrained and says about one half."""
    sample = labelled_sample(docs, labels, label, rows, TRAIN_MAX_CHARS, key, text)
    net, draw = ByteCnn(), np.random.default_rng(2)
    adam = Adam(net.weights, rate=0.01, decay=1e-5)
    texts, wanted = sample["text"].tolist(), sample["label"].to_numpy(np.float32)
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // max(1, len(texts))))
    for epoch in range(epochs if texts else 0):
        if epoch == epochs - 3:
            adam.rate /= 4
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            symbols, owner = chunk_symbols([texts[i] for i in chosen])
            adam.step(net.gradients(symbols, owner, wanted[chosen]))
    return net


def quality_score(net: ByteCnn, text: Column) -> Column:
    """Probability of label 1 for a text column. A null text counts as empty; every text is read
    to its end, in blocks of chunks, so memory does not follow its length."""

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts = [text or "" for text in series]
            parts = [net.score(texts[a:b]) for a, b in chunks(texts, 1_000_000)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return udf(text)


def classify(docs: DataFrame, net: ByteCnn, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<key>, score, predicted)``, one row per row of ``docs``; ``predicted`` is 1 from THRESHOLD
    on. Null and empty texts get the score of an empty text, repeated rows equal scores; other
    columns are not read."""
    return docs.select(F.col(key), quality_score(net, F.col(text)).alias("score")).select(
        key, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
