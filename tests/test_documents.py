from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from quillrank.functions.porter import may_change, may_stem, signs_of_stem, stem_word
from quillrank.operators import documents, matching, sieve, stats
from quillrank.sources.queries import distinct_queries, parse_queries

from helpers import article, articles_frame, queries_frame


def postings_of(spark, lines):
    return matching.query_postings(parse_queries(distinct_queries(queries_frame(spark, lines))))


def bodies(spark, rows):
    frame = articles_frame(spark, rows)
    return [r[0] for r in frame.select(documents.body_text(F.col("contents"))).collect()]


def test_only_paragraphs_with_text_count(spark):
    items = [None, (None, "paragraph"), ("kicker text", "kicker"), ("Capital", "Paragraph"),
             ("no subtype", None), ("one", "paragraph"), ("", "paragraph"), ("two", "paragraph")]
    assert bodies(spark, [article("a", "t", items=items)]) == ["one  two"]


def test_limit_follows_the_filter(spark):
    skipped = [("x", "image")] * 5 + [(f"p{i}", "paragraph") for i in range(7)]
    assert bodies(spark, [article("a", "t", items=skipped)]) == ["p0 p1 p2 p3 p4"]


def test_null_or_empty_contents_give_an_empty_body(spark):
    assert bodies(spark, [("a", "t", None), ("b", "t", [])]) == ["", ""]


def test_title_and_body_are_tokenised_apart(spark):
    frame = articles_frame(spark, [article("a", "Harbour bond", "s rise"), article("b", None, "x")])
    rows = {r.doc_id: r.terms for r in documents.document_terms(frame).collect()}
    assert rows == {"a": ["harbour", "bond", "rise"], "b": ["x"]}


def test_length_is_the_number_of_terms(spark):
    frame = articles_frame(spark, [article("a", "The bonds of a harbour", "bonds rose and rose")])
    terms = documents.document_terms(frame).first().terms
    assert documents.document_length(frame).first().dl == len(terms) == 5


def sieve_of(spark, terms):
    return sieve.TermSieve.of(spark.createDataFrame([(t,) for t in terms], "term string"))


def test_the_sieve_loses_no_term(spark):
    rows = [article(str(i), "running runner runs ran", "relational relate possibility possible y")
            for i in range(3)] + [article("n", None, "relates"), article("e", "", "")]
    rows.append(article("s", "mr mrs mrses by bys", "sky skies tables tabled ties tie i is"))
    frame = articles_frame(spark, rows)
    full = {r.doc_id: r for r in documents.document_matches(frame).collect()}
    for wanted in (["run", "relat"], ["possibl"], ["y"], ["mr"], ["sky", "ski"], ["tabl", "ti"],
                   [], ["zzzz"]):
        narrow = documents.document_matches(frame, sieve_of(spark, wanted)).collect()
        assert len(narrow) == len(full)
        for r in narrow:
            assert (r.title, r.dl) == (full[r.doc_id].title, full[r.doc_id].dl)
            assert set(r.matches) <= set(full[r.doc_id].matches)
            assert ([m for m in r.matches if m.term in wanted]
                    == [m for m in full[r.doc_id].matches if m.term in wanted])


def test_every_word_shows_the_signs_of_its_stem(spark):
    """All words of up to three of these letters, with every ending that the rules look at."""
    letters = "aeiouybltszdng"
    words = ["".join(w) for n in (1, 2, 3) for w in itertools.product(letters, repeat=n)]
    ends = (
        "|s|es|ed|ing|eds|ings|y|ys|ies|e|ate|ated|ational|bility|bilities|bly|ization|izer|ness|"
        "ful|ement|ion|ying|ied|eed|er|ance|al|ll|lled|ousness|iviti|abli|alli|eli|iciti|logi"
    ).split("|")
    stemmed = spark.createDataFrame([(w,) for w in words], "w string").repartition(8).select(
        F.explode(F.array(*[F.concat("w", F.lit(end)) for end in ends])).alias("w")
    ).select("w", stem_word(F.col("w")).alias("stem")).select(
        "w", "stem", F.transform(
            signs_of_stem(F.col("stem")), lambda s: F.concat_ws(":", s["kind"], s["word"])
        ).alias("signs"),
    )
    shown = may_stem(
        F.col("w"), lambda kind, w: F.array_contains("signs", F.concat(F.lit(f"{kind}:"), w))
    )
    assert [(r.w, r.stem) for r in stemmed.where(~shown).limit(5).collect()] == []


def test_the_sieve_drops_most_other_words(spark):
    one = sieve_of(spark, ["harbour", "bond"])
    words = spark.range(5000).select(F.conv(F.col("id") * 7919 + 36**4, 10, 36).alias("w"))
    lower = words.select(F.lower("w").alias("w"))
    assert lower.where(one.may_stem_to_term(F.col("w"))).count() < 25


def test_statistics_count_every_article(spark):
    frame = articles_frame(spark, [
        article("a", "bond", "marta bond"), article("n", None, "bond"), article("z", "river", "")
    ])
    matches = documents.document_matches(frame)
    assert tuple(stats.corpus_stats(matches).first()) == (3, 5, 5 / 3)
    postings = postings_of(spark, ["bond", "marta bond", "bond"])
    per_query = {r.term: r.cf for r in stats.corpus_term_freq(matches, postings).collect()}
    corpus = {r.term: r.cf
              for r in stats.corpus_term_freq(matches, postings, "corpus").collect()}
    assert per_query == {"bond": 9, "marta": 1}
    assert corpus == {"bond": 3, "marta": 1}


def test_empty_corpus_has_no_average(spark):
    matches = documents.document_matches(articles_frame(spark, []))
    assert tuple(stats.corpus_stats(matches).first()) == (0, 0, None)


def test_candidates_need_a_title_and_a_term(spark):
    frame = articles_frame(spark, [
        article("a", "bond bond", "x"), article("n", None, "bond"), article("z", "river", "y"),
        article("e", "", "bond"),
    ])
    matches = documents.document_matches(frame)
    postings = postings_of(spark, ["bond", "marta bond"])
    rows = sorted(map(tuple, matching.candidates(matches, postings).collect()))
    assert rows == [("bond", "a", "bond", 2, 3), ("bond", "e", "bond", 1, 1),
                    ("marta bond", "a", "bond", 2, 3), ("marta bond", "e", "bond", 1, 1)]
    pairs = sorted(map(tuple, matching.query_doc_match(matches, postings).collect()))
    assert ("bond", "n") in pairs and ("bond", "z") not in pairs
    maps = matching.term_freq_map(matching.term_freq(matches, postings))
    assert {(r.query_id, r.doc_id): r.term_freq for r in maps.collect()}[("bond", "a")] == {"bond": 2}


def test_query_postings(spark):
    rows = {(r.query_id, r.term): (r.n_terms, r.n_lines)
            for r in postings_of(spark, ["bond bond", "on the", "", "bonds", "bonds"]).collect()}
    assert rows == {("bond bond", "bond"): (2, 1), ("bonds", "bond"): (1, 2)}


def test_words_with_other_ends_are_their_own_stems(spark):
    rng = random.Random(9)
    words = {"".join(rng.choice("aeioubcdhklmnprstvyz") for _ in range(rng.randint(1, 8))) for _ in range(20_000)}
    rows = spark.createDataFrame([(w,) for w in sorted(words)], "x string")
    own = rows.where(f"NOT ({may_change('x')})")
    assert own.where(stem_word(F.col("x")) != F.col("x")).count() == 0
    assert own.count() > len(words) / 3
    # only the others pass the rules, so those tokens are taken apart before
    articles = spark.createDataFrame([("a", "book running", None)], "id string, title string, "
                                     "contents array<struct<content:string,subtype:string>>")
    matches = documents.document_matches(articles).select("matches")
    assert matches.first()[0] == [("book", 1), ("run", 1)]
    plan = matches._jdf.queryExecution().optimizedPlan().toString()
    assert "IN (s,y,e)" in plan
