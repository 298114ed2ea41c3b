"""Small fixtures and a brute-force version of the search, one query and document at a time."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillrank.functions.porter import stem_word
from quillrank.functions.text import STOPWORDS
from quillrank.sources.articles import RANKING_FIELDS


def article(doc_id, title, *paragraphs, items=None):
    contents = items if items is not None else [(text, "paragraph") for text in paragraphs]
    return (doc_id, title, contents)


def articles_frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), RANKING_FIELDS)


def queries_frame(spark: SparkSession, lines) -> DataFrame:
    return spark.createDataFrame([(line,) for line in lines], "original_query string")


def stems_of(spark: SparkSession, words) -> dict[str, str]:
    rows = spark.createDataFrame([(word,) for word in sorted(set(words))], "word string")
    return {r.word: r.stem for r in
            rows.select("word", stem_word(F.col("word")).alias("stem")).collect()}


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def near(a: str, b: str, min_distance: float = 0.5) -> bool:
    longer = max(len(a), len(b))
    return longer > 0 and edit_distance(a, b) / longer < min_distance


def greedy(ranked, k=10, min_distance=0.5):
    """``ranked`` are (score, doc_id, title) in any order."""
    kept = []
    for row in sorted(ranked, key=lambda r: (-round(r[0], 9), r[1])):
        if len(kept) < k and not any(near(row[2], other[2], min_distance) for other in kept):
            kept.append(row)
    return kept


def brute_force(spark, lines, rows, *, cf_mode="per_query", ratio="floor", k=10,
                max_paragraphs=5, min_distance=0.5):
    """{query: [(doc_id, score, title), …]} for articles as built by ``article``."""
    def words(text):
        return [w for w in (t.lower() for t in re.findall("[A-Za-z0-9]+", text or ""))
                if w not in STOPWORDS]

    plain = []
    for doc_id, title, contents in rows:
        texts = [c[0] for c in contents or []
                 if c is not None and c[0] is not None and c[1] == "paragraph"]
        plain.append((doc_id, title, words(title) + words(" ".join(texts[:max_paragraphs]))))
    stems = stems_of(spark, [w for *_, ws in plain for w in ws]
                     + [w for line in lines for w in words(line)] + ["x"])
    docs = [(d, t, Counter(stems[w] for w in ws), len(ws)) for d, t, ws in plain]
    terms = {line: [stems[w] for w in words(line)] for line in lines}
    multiplicity = Counter(t for line in lines for t in set(terms[line]))
    n_docs = len(docs)
    avgdl = sum(dl for *_, dl in docs) / n_docs
    result = {}
    for line in dict.fromkeys(lines):
        scored = []
        for doc_id, title, counts, dl in docs:
            hits = sorted(set(terms[line]) & set(counts))
            if not hits or title is None:
                continue
            total = 0.0
            for t in hits:
                tf, cf = counts[t], sum(c[t] for _, _, c, _ in docs)
                if cf_mode == "per_query":
                    cf *= multiplicity[t]
                r = n_docs // cf if ratio == "floor" else n_docs / cf
                f = tf / dl if tf < dl else 0.99999
                inner = tf * avgdl / dl * r
                gain = math.log2(inner) if inner > 0 else -math.inf
                total += (1 - f) ** 2 / (tf + 1) * (
                    tf * gain + 0.5 * math.log2(2 * math.pi * tf * (1 - f)))
            scored.append((total / len(terms[line]), doc_id, title))
        if scored:
            result[line] = [(d, s, t) for s, d, t in greedy(scored, k, min_distance)]
    return result


def as_lists(rankings: DataFrame):
    found = {}
    for r in sorted(rankings.collect(), key=lambda r: (r.query_id, r["rank"])):
        rows = found.setdefault(r.original_query, [])
        assert r["rank"] == len(rows) + 1
        rows.append((r.doc_id, r.score, r.title))
    return found


def assert_same(found, expected):
    assert found.keys() == expected.keys()
    for query, rows in expected.items():
        assert [(d, t) for d, _, t in found[query]] == [(d, t) for d, _, t in rows], query
        for (_, a, _), (_, b, _) in zip(found[query], rows):
            assert a == b or abs(a - b) < 1e-9
