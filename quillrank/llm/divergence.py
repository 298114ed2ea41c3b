"""Quality rules by distribution divergence from language references."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parameters of the method.
COMMON_SHARE = 0.002      # a word is common in a language from this share of its words on
MIN_CLASS_CHARS = 200     # shorter texts are not judged by their character classes
MIN_COMMON_WORDS = 100    # texts with fewer words are not judged by their common words
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.38

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_WORD_BREAK = r"[\x20\x09-\x0D]+"

CLASSES = ["lower", "upper", "digit", "space", "symbol", "point", "beyond_ascii"]
_DISTINCT_LIMIT = 2_000_000  # word ids that still fit three into 63 bits


def _class_table() -> np.ndarray:
    """Class number of each ASCII code point; everything further is the last class."""
    table = np.full(128, CLASSES.index("point"), dtype=np.uint8)
    for code in range(128):
        char = chr(code)
        if char in _SPACES:
            table[code] = CLASSES.index("space")
        elif char in SYMBOLS:
            table[code] = CLASSES.index("symbol")
        elif char.isdigit():
            table[code] = CLASSES.index("digit")
        elif char.isalpha():
            table[code] = CLASSES.index("lower" if char.islower() else "upper")
    return table


_CLASS_OF = _class_table()


def class_histogram(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ascii_codes = codes[codes < 128]
    counts = np.bincount(_CLASS_OF[ascii_codes], minlength=len(CLASSES))
    counts[-1] += len(codes) - len(ascii_codes)
    return counts


def repeat_words(words: list[bytes]) -> int:
    """How many words stand in a 3-word window that occurs twice or more in the text."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(word, len(known)) for word in words], dtype=np.int64)
    if len(known) <= _DISTINCT_LIMIT:
        windows = (ids[:-2] * len(known) + ids[1:-1]) * len(known) + ids[2:]
    else:  # number the pairs first, so that a window is two small numbers
        pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(known) + ids[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[place] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def base_counts(text: str, words: list[bytes], data: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(text.count(space) for space in _SPACES),
        sum(text.count(symbol) for symbol in SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms (square root of the divergence in bits): 0
    for equal shapes, 1 for disjoint ones; 1 if just one of them is empty, 0 if both are."""
    if not p.sum() or not q.sum():
        return float(bool(p.sum()) != bool(q.sum()))
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2

    def against(x):
        on = x > 0
        return float((x[on] * np.log2(x[on] / middle[on])).sum())

    return float(np.sqrt(min(1.0, max(0.0, (against(p) + against(q)) / 2))))


def _class_counts(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([class_histogram(text or "").tolist() for text in texts])

    return udf(text)


def references(
    docs: DataFrame, lang: str = "lang", text: str = "text", share: float = COMMON_SHARE
) -> dict[str, dict]:
    """Per language: ``classes``, the histogram of character classes, and ``words``, the counts
    of its common words with ``None`` for all others together; over all documents with a
    language. Words are lower-cased.

    Words are counted by (language, word) with partial aggregation, so a frequent word or a
    dominant language costs one row per task. What reaches the driver is bounded: a language has
    at most 1/``share`` common words and one histogram.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    histograms = known.select("lang", _class_counts(F.col("text")).alias("n")).groupBy("lang").agg(
        *[F.sum(F.col("n")[i]).alias(name) for i, name in enumerate(CLASSES)]
    )
    found = {
        row["lang"]: {"classes": np.array([row[name] for name in CLASSES], dtype=np.int64)}
        for row in histograms.collect()
    }
    words = known.select("lang", F.explode(F.split(F.lower("text"), _WORD_BREAK)).alias("word"))
    counts = words.where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    common = counts.join(F.broadcast(totals), "lang").where(F.col("n") >= F.col("total") * share)
    rows = common.collect()
    for name, reference in found.items():
        own = {row["word"]: row["n"] for row in rows if row["lang"] == name}
        total = next((row["total"] for row in rows if row["lang"] == name), 0)
        reference["words"] = own | {None: total - sum(own.values())}
    return found


class Judge:
    """Compares single texts with the references."""

    def __init__(self, refs: dict[str, dict]):
        self.refs = {
            lang: (
                ref["classes"],
                {word: i for i, word in enumerate(ref["words"])},
                np.array(list(ref["words"].values()), dtype=np.int64),
            )
            for lang, ref in refs.items()
        }

    def distances(self, lang: str | None, classes, words: list[str]) -> tuple[float, float]:
        """Class and word distance to the reference of the language; where that is null or
        unknown, the least distance to any reference. 0 where there is no reference."""
        refs = [self.refs[lang]] if lang in self.refs else list(self.refs.values())
        by_class, by_word = [], []
        for reference, index, counts in refs:
            by_class.append(js_distance(classes, reference))
            places = [index.get(word, index[None]) for word in words]
            by_word.append(
                js_distance(np.bincount(np.array(places, dtype=np.int64),
                                        minlength=len(counts)), counts)
            )
        return min(by_class, default=0.0), min(by_word, default=0.0)


_FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, class_distance double, word_distance double, kept boolean"
)


def judge_text(judge: Judge, text: str | None, lang: str | None) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    counts = base_counts(text, words, data)
    n_words, repeated = counts[0], counts[4]
    failed = n_words < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n_words
    lowered = [word for word in text.lower().encode("utf-8", "surrogatepass").split()]
    by_class, by_word = judge.distances(
        lang, class_histogram(text), [w.decode("utf-8", "surrogatepass") for w in lowered]
    )
    off = (len(text) >= MIN_CLASS_CHARS and by_class > MAX_CLASS_DISTANCE) or (
        n_words >= MIN_COMMON_WORDS and by_word > MAX_WORD_DISTANCE
    )
    return (*counts, failed, by_class, by_word, not failed and not off)


def quality_rules(docs: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text",
                  refs: dict[str, dict] | None = None) -> DataFrame:
    """``(<key>, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance, kept)``, one row per row of ``docs``.

    A text fails the base rules with fewer than 50 words, or if more than half of its words
    stand in repeated 3-word windows. Otherwise it is kept unless its character classes or its
    common words lie further from those of its language than the limits; short texts are not
    judged by that (``MIN_CLASS_CHARS``, ``MIN_COMMON_WORDS``). A null text counts as empty and
    fails; a null or unknown language is compared with the nearest reference; repeated rows
    get equal answers; an empty table gives an empty result. Texts are judged one by one, in
    Arrow batches; ``refs`` defaults to the references of ``docs`` itself.
    """
    judge = Judge(references(docs, lang, text) if refs is None else refs)

    @F.pandas_udf(_FIELDS)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in _FIELDS.split(", ")]
        for texts, langs in batches:
            rows = [judge_text(judge, t, g) for t, g in zip(texts, langs, strict=True)]
            yield pd.DataFrame(rows, columns=names)

    answer = judged(F.col(text), F.col(lang).cast("string")).alias("answer")
    return docs.select(F.col(key), answer).select(key, "answer.*")
