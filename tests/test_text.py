from __future__ import annotations

import random

import pyarrow.parquet as pq
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from quillrank.functions import text
from quillrank.functions.porter import may_stem_to, stem_word

# Words and stems given as examples in the paper, carried through all steps.
PAPER = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered
plaster bled bled motoring motor sing sing conflated conflat troubled troubl sized size
hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy
happi sky sky relational relat conditional condit rational ration valenci valenc hesitanci
hesit digitizer digit conformabli conform radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer
airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog
communism commun activate activ angulariti angular homologous homolog effective effect
bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
generalizations gener oscillators oscil
""".split()

# Short words stay, a final y needs a vowel before it, an initial y is a consonant.
CORNERS = """
ay ay ays ai de de is is as as s s yes ye ying ying yelling yell sayings sai eing e
possibility possibl 2012 2012 x1ing x1ing a1s a1
""".split()


def column(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_published_examples(spark):
    words = dict(zip(PAPER[::2], PAPER[1::2])) | dict(zip(CORNERS[::2], CORNERS[1::2]))
    rows = column(spark, words).select("x", stem_word(F.col("x")).alias("s")).collect()
    assert {r.x: r.s for r in rows} == words


def test_a_stem_starts_like_its_word(spark):
    rng = random.Random(7)
    suffixes = """ational tional enci anci ency ancy izer ably alli ally entli ently eli ely
        ousli ously ization ation ator alism iveness fulness ousness aliti ality iviti ivity
        biliti bility icate ative alize iciti icity ical ful ness al ance ence er ic able ible
        ant ement ment ent ion ou ism ate iti ity ous ive ize ed ing eed s es ies sses y ying
        ated bled ized ll""".split()
    words = set()
    for _ in range(20000):
        root = "".join(rng.choice("aeiouybcdlnst") for _ in range(rng.randint(0, 5)))
        words.add(root + "".join(rng.sample(suffixes, rng.randint(0, 3))))
    words.discard("")
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])
    tokens = column(spark, table["text"].to_pylist(), "t").select(
        F.explode(text.tokenise(F.col("t"))).alias("x")
    )
    rows = column(spark, words).union(tokens).distinct()
    stemmed = rows.select("x", stem_word(F.col("x")).alias("s"))
    found = stemmed.collect()
    for r in found:
        sure = r.s[:-1] if r.s.endswith(("e", "i", "bl")) and len(r.s) > 1 else r.s
        assert r.s and r.x.startswith(sure), r
        if not set(r.s) & set("aeiouy"):
            assert r.x in (r.s, r.s + "s", r.s + "es"), r
    stems = [r.s for r in stemmed.select("s").distinct().orderBy(F.xxhash64("s")).head(300)]
    hit = stemmed.where(F.col("s").isin(stems))
    assert hit.where(f"NOT ({may_stem_to(stems)})").count() == 0
    assert hit.count() >= 300


def test_tokenise(spark):
    rows = column(spark, ["The U.S.-led Deal, 2012!", "", None, "café ça", "a\nb"])
    got = [r[0] for r in rows.select(text.tokenise(F.col("x"))).collect()]
    assert got == [["the", "u", "s", "led", "deal", "2012"], [], [], ["caf", "a"], ["a", "b"]]


def test_stopwords_are_sparks_own(spark):
    assert list(text.STOPWORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_terms_keep_order_and_repeats(spark):
    rows = column(spark, ["On the running of runs; the IPO of running"])
    assert rows.select(text.terms(F.col("x"))).first()[0] == ["run", "run", "ipo", "run"]


def test_parameters(spark):
    rows = column(spark, ["don't stop x-ray"])
    own = text.terms(F.col("x"), "[a-z'-]+", ("don't",))
    assert rows.select(own).first()[0] == ["stop", "x-rai"]
    assert rows.select(text.terms(F.col("x"), "[a-z'-]+", ())).first()[0][0] == "don't"


def test_count_runs(spark):
    rows = spark.createDataFrame([(["b", "a", "b"],), ([],), (["a"],)], "x array<string>")
    counted = rows.select(F.sort_array("x").alias("x")).select(text.count_runs(F.col("x")))
    assert [[tuple(c) for c in r[0]] for r in counted.collect()] == [
        [("a", 1), ("b", 2)], [], [("a", 1)]
    ]
