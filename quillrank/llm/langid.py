"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.llm.pieces import MODEL_PATH, SPACE, load_pieces
from quillrank.llm.shared import Scratch, bounded_share, chunks, give_back, tidy

UNDETERMINED = "und"
TRAIN_DOCS_PER_LANG = 2000   # bound of the training sample, in expectation
TRAIN_MAX_CHARS = 200_000    # longer texts are not used for training (they are scored whole)
EM_ROUNDS = 2
SMOOTHING = 0.01             # added to the expected count of every piece
RUN_LETTERS = 48             # longer letter runs are scored in parts of this many letters

# Runs of letters, lower-cased, are the words; nothing else is scored.
_RUN = re.compile(rf"[^\W\d_]{{1,{RUN_LETTERS}}}")
# The vocabulary is blown up by e^TILT per character, and down again at the end, which keeps
# products of up to RUN_LETTERS + 1 small probabilities within double precision.
_TILT = 4.0
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _RUN.findall(text.lower())


class Lattice:
    """Finds all pieces in many words at once, by rolling hashes of their substrings."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        hashes = np.array([self._hash(piece) for piece in pieces], dtype=np.uint64)
        prefixes = {piece[:n] for piece in pieces for n in range(1, len(piece))}
        self._prefixes = np.sort(
            np.array([self._hash(prefix) for prefix in prefixes], dtype=np.uint64)
        )
        order = np.argsort(hashes)
        self._hashes, self._ids = hashes[order], order

    @staticmethod
    def _hash(text: str) -> np.uint64:
        value = 0
        for char in text:
            value = (value * int(_MULTIPLIER) + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return np.uint64(value)

    def edges(self, codes: np.ndarray):
        """For words of equal length as a matrix of code points: ``(start, length, rows,
        piece ids)`` for every start and length at which some rows hold a piece. Single
        characters always have an edge, with id ``len(pieces)`` if they are no piece."""
        count, length = codes.shape
        for start in range(length):
            rows, value = np.arange(count), np.zeros(count, dtype=np.uint64)
            for size in range(1, min(self.longest, length - start) + 1):
                value = value * _MULTIPLIER + (codes[rows, start + size - 1] + np.uint64(1))
                at = np.searchsorted(self._hashes, value)
                at[at == len(self._hashes)] = 0
                hit = self._hashes[at] == value
                if size == 1:
                    yield start, 1, rows, np.where(hit, self._ids[at], len(self.pieces))
                elif hit.any():
                    yield start, size, rows[hit], self._ids[at[hit]]
                at = np.searchsorted(self._prefixes, value)
                at[at == len(self._prefixes)] = 0
                more = self._prefixes[at] == value
                rows, value = rows[more], value[more]
                if not len(rows):
                    break


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(indices, code points)`` of words of equal length, each with the leading space mark."""
    lengths = np.array([len(word) for word in words])
    for length in np.unique(lengths):
        chosen = np.flatnonzero(lengths == length)
        text = "".join(SPACE + words[i] for i in chosen)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        yield chosen, codes.reshape(len(chosen), length + 1)


def _tilted(probabilities: np.ndarray, pieces: list[str]) -> np.ndarray:
    sizes = np.array([len(piece) for piece in pieces] + [1])
    return probabilities * np.exp(_TILT * sizes)[:, None]


def word_log_probabilities(
    lattice: Lattice, probabilities: np.ndarray, words: list[str]
) -> np.ndarray:
    """Log of the probability of each word under each language, summed over all its
    segmentations by the forward algorithm. ``probabilities`` has a row per piece (and one for
    unknown characters) and a column per language."""
    tilted = _tilted(probabilities, lattice.pieces)
    result = np.zeros((len(words), probabilities.shape[1]))
    for chosen, codes in _by_length(words):
        forward = np.zeros((codes.shape[1] + 1, len(codes), probabilities.shape[1]))
        forward[0] = 1.0
        for start, size, rows, ids in lattice.edges(codes):
            forward[start + size][rows] += forward[start][rows] * tilted[ids]
        result[chosen] = np.log(forward[-1]) - _TILT * codes.shape[1]
    return result


def expected_counts(
    lattice: Lattice, probabilities: np.ndarray, words: list[str], counts: np.ndarray
) -> np.ndarray:
    """Expected number of uses of each piece per language (forward-backward). ``counts`` has a
    row per word and a column per language."""
    tilted = _tilted(probabilities, lattice.pieces)
    result = np.zeros_like(probabilities)
    for chosen, codes in _by_length(words):
        shape = (codes.shape[1] + 1, len(codes), probabilities.shape[1])
        forward, backward = np.zeros(shape), np.zeros(shape)
        forward[0] = backward[-1] = 1.0
        edges = list(lattice.edges(codes))
        for start, size, rows, ids in edges:
            forward[start + size][rows] += forward[start][rows] * tilted[ids]
        for start, size, rows, ids in reversed(edges):
            backward[start][rows] += backward[start + size][rows] * tilted[ids]
        weight = counts[chosen] / forward[-1]
        for start, size, rows, ids in edges:
            share = forward[start][rows] * tilted[ids] * backward[start + size][rows]
            np.add.at(result, ids, share * weight[rows])
    return result


@dataclass(frozen=True)
class LanguageModel:
    langs: list[str]
    pieces: list[str]
    probabilities: np.ndarray   # (pieces + 1, langs); the last row is for unknown characters
    log_prior: np.ndarray


def _training_sample(docs: DataFrame, key: str, lang: str, text: str, per_lang: int) -> DataFrame:
    """About ``per_lang`` documents of each language at most, picked by hash of the key.
    The shares are one row per language, so they are broadcast and no text is exchanged."""
    usable = docs.where(F.col(lang).isNotNull() & (F.length(text) <= TRAIN_MAX_CHARS)).select(
        F.col(key).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    sizes = docs.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(
        F.least(F.lit(1.0), per_lang / F.count(F.lit(1))).alias("share")
    )
    return usable.join(F.broadcast(sizes), "lang").where(bounded_share(F.col("id"), F.col("share")))


def train(
    docs: DataFrame,
    key: str = "doc_id",
    lang: str = "lang",
    text: str = "text",
    path: str = MODEL_PATH,
    per_lang: int = TRAIN_DOCS_PER_LANG,
) -> LanguageModel | None:
    """Piece probabilities of every language in ``docs``, by expectation-maximisation from
    uniform ones; ``None`` if no document has a language and a letter.

    Fitted on a sample of about ``per_lang`` documents a language. Spark reduces it to counts
    of (language, word) and sums the expected piece counts of the tasks; the driver sees
    vocabulary times languages numbers a round.
    """
    scratch = Scratch(docs.sparkSession)
    sample = _training_sample(docs, key, lang, text, per_lang)

    @F.pandas_udf("array<string>")
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([words_of(text) for text in texts])
        give_back()

    counts = scratch.table(
        "word-counts",
        sample.select("lang", F.explode(words("text")).alias("word"))
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")),
    )
    sizes = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    pieces = [piece.text for piece in load_pieces(path).pieces]
    probabilities = np.full((len(pieces) + 1, len(langs)), 1.0 / (len(pieces) + 1))
    for _ in range(EM_ROUNDS):
        current = probabilities

        def expect(batches: Iterator[pd.DataFrame], current=current) -> Iterator[pd.DataFrame]:
            lattice, total = Lattice(pieces), np.zeros_like(current)
            for rows in batches:
                known = pd.factorize(rows["word"])
                table = np.zeros((len(known[1]), len(langs)))
                np.add.at(table, (known[0], [langs.index(x) for x in rows["lang"]]), rows["n"])
                total += expected_counts(lattice, current, list(known[1]), table)
            ids, column = np.nonzero(total)
            yield pd.DataFrame({"piece": ids, "lang": column, "n": total[ids, column]})

        summed = (
            counts.mapInPandas(tidy(expect), "piece long, lang long, n double")
            .groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        ).toPandas()
        table = np.full_like(probabilities, SMOOTHING)
        table[summed["piece"], summed["lang"]] += summed["n"]
        probabilities = table / table.sum(axis=0)
    return LanguageModel(langs, pieces, probabilities, np.zeros(len(langs)))


def score_texts(model: LanguageModel, lattice: Lattice, texts: list[str]) -> np.ndarray:
    """Posterior of each language for each text; every distinct word is scored once per call."""
    known: dict[str, int] = {}
    places, sizes = [], []
    for text in texts:
        words = words_of(text)
        places.append(
            np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        )
        sizes.append(len(words))
    logs = np.tile(model.log_prior, (len(texts), 1))
    if known:
        by_word = word_log_probabilities(lattice, model.probabilities, list(known))
        owner = np.repeat(np.arange(len(texts)), sizes)
        every = np.concatenate(places)
        for column in range(logs.shape[1]):
            logs[:, column] += np.bincount(
                owner, weights=by_word[every, column], minlength=len(texts)
            )
    logs -= logs.max(axis=1, keepdims=True)
    shares = np.exp(logs)
    return shares / shares.sum(axis=1, keepdims=True)


def predict(model: LanguageModel | None, text: Column) -> Column:
    """``struct<lang string, score double>`` of a text column: the language with the largest
    posterior (ties: the first by name) and that posterior; ``und`` with score 0 where the text is
    null or has no letter, or where no language could be learned."""

    @F.pandas_udf("lang string, score double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(model.pieces) if model else None
        for series in batches:
            texts = [text or "" for text in series]
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            for start, stop in chunks(texts) if model else ():
                part = texts[start:stop]
                shares = score_texts(model, lattice, part)
                best = shares.argmax(axis=1)
                for i, text in enumerate(part):
                    if any(map(str.isalpha, text)):
                        langs[start + i] = model.langs[best[i]]
                        scores[start + i] = shares[i, best[i]]
            yield pd.DataFrame({"lang": langs, "score": scores})
        give_back()

    return udf.asNondeterministic()(text)


def identify(docs: DataFrame, model: LanguageModel | None, key: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``(<key>, lang_pred, score)``, one row per row of ``docs``. Null and empty texts, and texts
    without a letter, are ``und``; repeated rows get equal answers; other columns are not read."""
    return docs.select(F.col(key), predict(model, F.col(text)).alias("answer")).select(
        key, F.col("answer.lang").alias("lang_pred"), F.col("answer.score").alias("score")
    )
