"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.shared import chunks
from quillrank.llm.training import Adam, labelled_sample, sigmoid

WINDOW = 32            # words of a window
MARGIN = 4             # words at either end that are context only; windows overlap by these
HIDDEN = 8             # state size of each direction
WORD_ROWS = 1 << 14    # rows of the hashed word table
CHAR_ROWS = 1 << 12    # rows of the hashed character trigram table
WIDTH = 8              # columns of either table
THRESHOLD = 0.3
TRAIN_ROWS = 4000      # bound of the training sample
TRAIN_MAX_CHARS = 20_000
EPOCHS = 4
MIN_STEPS = 150        # small samples are passed more often
BATCH = 48
_BLOCK = 4096          # windows run at once
_OWN = WINDOW - 2 * MARGIN
_WORD = re.compile(r"\w+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Vocabulary:
    """Distinct words with their hashed table rows: the word as a whole, and its character
    trigrams with marked ends."""

    def __init__(self, words: list[str]):
        codes = np.frombuffer(
            "".join(f"\x02{word}\x03" for word in words).encode("utf-32-le", "surrogatepass"),
            dtype="<u4",
        ).astype(np.uint64)
        sizes = np.array([len(word) for word in words], dtype=np.int64)  # trigrams per word
        ends = np.cumsum(sizes + 2)
        keep = np.ones(len(codes), dtype=bool)
        keep[ends - 1] = keep[ends - 2] = False
        at = np.flatnonzero(keep)
        grams = codes[at] * _MIX[0] + codes[at + 1] * _MIX[1] + codes[at + 2] * _MIX[2]
        grams ^= grams >> np.uint64(29)
        grams *= _MIX[1]
        grams ^= grams >> np.uint64(32)
        self.first = np.cumsum(sizes) - sizes
        self.sizes = sizes
        self.grams = (grams % np.uint64(CHAR_ROWS)).astype(np.int64)
        whole = np.add.reduceat(grams, self.first) * _MIX[2]
        self.words = ((whole ^ (whole >> np.uint64(31))) % np.uint64(WORD_ROWS)).astype(np.int64)


def windows_of(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, owner)``: overlapping windows over word numbers, -1 for padding. Each word stands in
    the middle part of one window and has MARGIN words of context or more around it; a text
    without words has one empty window."""
    rows, owner = [], []
    for i, ids in enumerate(places):
        count = max(1, -(-len(ids) // _OWN))
        padded = np.full((count - 1) * _OWN + WINDOW, -1, dtype=np.int64)
        padded[MARGIN:MARGIN + len(ids)] = ids
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::_OWN])
        owner.append(np.full(count, i))
    return np.concatenate(rows), np.concatenate(owner)


class BiGru:
    """Input of a word: its row of the word table beside the mean of its trigram rows. A gated
    recurrent unit runs over each window in both directions. Attention over the middle words
    gives the window vector and so the window's logit. A text is judged by its worst window and
    by its attention mass (about how many words draw attention)."""

    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)

        def normal(scale, *shape):
            return draw.normal(0, scale, shape).astype(np.float32)

        self.weights = {
            "word": normal(0.05, WORD_ROWS, WIDTH),
            "char": normal(0.05, CHAR_ROWS, WIDTH),
            "attend": normal(0.5, 2 * HIDDEN),
            "attend_shift": np.full(1, -3, dtype=np.float32),
            "window": normal(0.5, 2 * HIDDEN),
            "text": np.array([0.5, 1.0], dtype=np.float32),
            "shift": np.full(1, -2, dtype=np.float32),
        }
        for side in "fb":
            self.weights[f"in_{side}"] = normal(0.5, 2 * WIDTH, 3 * HIDDEN)
            self.weights[f"loop_{side}"] = normal(0.3, HIDDEN, 3 * HIDDEN)
            self.weights[f"bias_{side}"] = np.zeros(3 * HIDDEN, dtype=np.float32)

    def inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        chars = np.add.reduceat(self.weights["char"][vocabulary.grams], vocabulary.first, axis=0)
        return np.concatenate(
            [self.weights["word"][vocabulary.words], chars / vocabulary.sizes[:, None]], axis=1
        ).astype(np.float32)

    def _projected(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        """Input part of the gates per word, last row for padding (all zero input)."""
        padded = np.concatenate([inputs, np.zeros((1, inputs.shape[1]), dtype=np.float32)])
        return {s: padded @ self.weights[f"in_{s}"] + self.weights[f"bias_{s}"] for s in "fb"}

    def _run(self, side: str, projected: np.ndarray, ids: np.ndarray, trace: list | None = None):
        """States of one direction, ``(windows, WINDOW, HIDDEN)``. Padding leaves the state as it is."""
        loop = self.weights[f"loop_{side}"]
        states = np.empty((len(ids), WINDOW, HIDDEN), dtype=np.float32)
        state = np.zeros((len(ids), HIDDEN), dtype=np.float32)
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            given, past = projected[ids[:, t]], state @ loop
            gates = sigmoid(given[:, :2 * HIDDEN] + past[:, :2 * HIDDEN])
            keep, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            fresh = np.tanh(given[:, 2 * HIDDEN:] + reset * past[:, 2 * HIDDEN:])
            real = (ids[:, t] >= 0)[:, None]
            after = np.where(real, fresh + keep * (state - fresh), state)
            if trace is not None:
                trace.append((t, state, past, keep, reset, fresh, real))
            state = after
            states[:, t] = state
        return states

    def _windows(self, states: np.ndarray, ids: np.ndarray):
        own = slice(MARGIN, MARGIN + _OWN)
        middle, real = states[:, own], ids[:, own] >= 0
        pull = middle @ self.weights["attend"] + self.weights["attend_shift"]
        pull = np.where(real, pull, np.float32(-30))
        share = np.exp(pull - pull.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        vector = np.einsum("nt,nth->nh", share, middle)
        mass = (sigmoid(pull) * real).sum(axis=1)
        return pull, share, vector, vector @ self.weights["window"], mass

    def score(self, texts: list[str]) -> np.ndarray:
        known: dict[str, int] = {}
        places = [
            np.array([known.setdefault(w, len(known)) for w in words_of(text)], dtype=np.int64)
            for text in texts
        ]
        inputs = (self.inputs(Vocabulary(list(known))) if known
                  else np.zeros((0, 2 * WIDTH), dtype=np.float32))
        projected = self._projected(inputs)
        ids, owner = windows_of(places)
        logits, mass = np.empty(len(ids)), np.empty(len(ids))
        for at in range(0, len(ids), _BLOCK):
            block = ids[at:at + _BLOCK]
            states = np.concatenate(
                [self._run(s, projected[s], block) for s in "fb"], axis=2
            )
            _, _, _, logits[at:at + _BLOCK], mass[at:at + _BLOCK] = self._windows(states, block)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return sigmoid(self._text_logit(
            np.maximum.reduceat(logits, first), np.add.reduceat(mass, first)
        ))

    def _text_logit(self, worst, mass):
        worst_weight, mass_weight = self.weights["text"]
        return worst_weight * worst + mass_weight * np.log1p(mass) + self.weights["shift"][0]

    def gradients(self, vocabulary: Vocabulary, ids, owner, labels) -> dict[str, np.ndarray]:
        """Of the mean cross entropy, back through time over all windows of the texts."""
        w, inputs = self.weights, self.inputs(vocabulary)
        projected, traces = self._projected(inputs), {"f": [], "b": []}
        states = np.concatenate(
            [self._run(s, projected[s], ids, traces[s]) for s in "fb"], axis=2
        )
        pull, share, vector, logits, mass = self._windows(states, ids)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        worst, total = np.maximum.reduceat(logits, first), np.add.reduceat(mass, first)
        error = (sigmoid(self._text_logit(worst, total)) - labels) / len(labels)
        out = {"text": np.array([error @ worst, error @ np.log1p(total)]),
               "shift": np.array([error.sum()])}
        at_logit = np.where(logits == worst[owner], error[owner] * w["text"][0], 0)
        at_mass = (error * w["text"][1] / (1 + total))[owner]
        out["window"] = at_logit @ vector
        at_vector = at_logit[:, None] * w["window"]
        own = slice(MARGIN, MARGIN + _OWN)
        middle, real = states[:, own], ids[:, own] >= 0
        at_share = np.einsum("nh,nth->nt", at_vector, middle)
        at_pull = share * (at_share - (share * at_share).sum(axis=1, keepdims=True))
        gate = sigmoid(pull)
        at_pull = (at_pull + at_mass[:, None] * gate * (1 - gate)) * real
        out["attend"] = np.einsum("nt,nth->h", at_pull, middle)
        out["attend_shift"] = np.array([at_pull.sum()])
        at_states = np.zeros_like(states)
        at_states[:, own] = at_pull[:, :, None] * w["attend"]
        at_states[:, own] += share[:, :, None] * at_vector[:, None]
        at_inputs = np.zeros((len(inputs) + 1, inputs.shape[1]), dtype=np.float32)
        padded = np.concatenate([inputs, np.zeros((1, inputs.shape[1]), dtype=np.float32)])
        for place, side in enumerate("fb"):
            mine = at_states[:, :, place * HIDDEN:(place + 1) * HIDDEN]
            at_given = np.zeros((len(ids), WINDOW, 3 * HIDDEN), dtype=np.float32)
            loop, at_loop = w[f"loop_{side}"], np.zeros_like(w[f"loop_{side}"])
            carried = np.zeros((len(ids), HIDDEN), dtype=np.float32)
            for t, state, past, keep, reset, fresh, is_word in reversed(traces[side]):
                at_state = carried + mine[:, t]
                through = at_state * is_word
                at_fresh = through * (1 - keep) * (1 - fresh * fresh)
                at_keep = through * (state - fresh) * keep * (1 - keep)
                at_reset = at_fresh * past[:, 2 * HIDDEN:] * reset * (1 - reset)
                at_given[:, t] = np.concatenate([at_keep, at_reset, at_fresh], axis=1)
                at_past = np.concatenate([at_keep, at_reset, at_fresh * reset], axis=1)
                at_loop += state.T @ at_past
                carried = at_state * ~is_word + through * keep + at_past @ loop.T
            out[f"loop_{side}"] = at_loop
            flat, rows = at_given.reshape(-1, 3 * HIDDEN), ids.reshape(-1)
            by_word = np.zeros((len(inputs) + 1, 3 * HIDDEN), dtype=np.float32)
            np.add.at(by_word, rows, flat)
            out[f"bias_{side}"] = flat.sum(axis=0)
            out[f"in_{side}"] = padded.T @ by_word
            at_inputs += by_word @ w[f"in_{side}"].T
        at_inputs = at_inputs[:-1]
        out["word"], out["char"] = np.zeros_like(w["word"]), np.zeros_like(w["char"])
        np.add.at(out["word"], vocabulary.words, at_inputs[:, :WIDTH])
        per_gram = (at_inputs[:, WIDTH:] / vocabulary.sizes[:, None]).repeat(
            vocabulary.sizes, axis=0
        )
        np.add.at(out["char"], vocabulary.grams, per_gram)
        return out


def _start_from_counts(net: BiGru, texts: list[list[str]], labels: np.ndarray) -> None:
    """The first column of the word table starts at the log odds of a word's documents, shrunk
    for rare words, so that training starts from what single words say."""
    counts = np.full((2, WORD_ROWS), 1.0)
    for words, label in zip(texts, labels, strict=True):
        distinct = list(dict.fromkeys(words))
        if distinct:
            counts[int(label > 0.5), np.unique(Vocabulary(distinct).words)] += 1
    ones = max(1.0, float((labels > 0.5).sum()))
    zeros = max(1.0, float((labels <= 0.5).sum()))
    odds = np.log(counts[1] / (ones + 2)) - np.log(counts[0] / (zeros + 2))
    sure = np.minimum(1, (counts.sum(axis=0) - 2) / 20)
    net.weights["word"][:, 0] = 0.5 * np.clip(odds * sure, -2, 4)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
          text: str = "text", rows: int = TRAIN_ROWS) -> BiGru:
    """A network fitted on a bounded sample of the labelled documents (``rows`` at most, in
    expectation; texts up to TRAIN_MAX_CHARS). Without any labelled row it stays untrained."""
    sample = labelled_sample(docs, labels, label, rows, TRAIN_MAX_CHARS, key, text)
    net, draw = BiGru(), np.random.default_rng(2)
    texts, wanted = [words_of(t) for t in sample["text"]], sample["label"].to_numpy(np.float32)
    if len(texts):
        _start_from_counts(net, texts, wanted)
    adam = Adam(net.weights, rate=0.01, decay=1e-6)
    epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // max(1, len(texts))))
    for epoch in range(epochs if texts else 0):
        if epoch == epochs - 2:
            adam.rate /= 4
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen, known = order[at:at + BATCH], {}
            places = [
                np.array([known.setdefault(w, len(known)) for w in texts[i]], dtype=np.int64)
                for i in chosen
            ]
            if known:
                adam.step(net.gradients(
                    Vocabulary(list(known)), *windows_of(places), wanted[chosen]
                ))
    return net


def toxicity_score(net: BiGru, text: Column) -> Column:
    """Probability of label 1 for a text column; a null text counts as empty. All windows of a
    text are scored, in blocks."""

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in batches:
            texts = [text or "" for text in series]
            parts = [net.score(texts[a:b]) for a, b in chunks(texts)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return udf(text)


def classify(docs: DataFrame, net: BiGru, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(<key>, score, predicted)``, one row per row of ``docs``; ``predicted`` is 1 from THRESHOLD
    on. Null and empty texts and texts without a word get the score of an empty window, repeated
    rows equal scores; other columns are not read."""
    return docs.select(F.col(key), toxicity_score(net, F.col(text)).alias("score")).select(
        key, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
