"""Document fingerprints by consistent weighted sampling. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.shared import Scratch

SAMPLES = 64
WORD_BREAK = r"[\x20\x09-\x0D]+"
_LOW = (1 << 32) - 1


def _uniform(bits: Column, shift: int, width: int = 26) -> Column:
    """Between 0 and 1, neither included, from some of 64 bits."""
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + 0.5) * F.lit(1.0 / (1 << width))


def draws(first: Column, second: Column) -> dict[str, Column]:
    """What a sample draws for a term, whatever its weight, from two hashes of term and sample: r and c from the gamma
    distribution of shape 2 (minus the log of two uniforms each; of c the logarithm), b uniform, and a hash."""
    rest = F.shiftleft(F.shiftrightunsigned(first, 52), 12) + F.shiftrightunsigned(second, 52)
    return {
        "r": -F.ln(_uniform(first, 0) * _uniform(first, 26)),
        "ln_c": F.ln(-F.ln(_uniform(second, 0) * _uniform(second, 26))),
        "b": _uniform(rest, 0, 24),
        "hash": first,
    }


def sample_key(log_weight: Column, drawn: dict[str, Column]) -> Column:
    """One consistent weighted sample of a term as a 64-bit number, the smallest of which wins.

    The weight S falls into the log-scale step t = floor(ln S / r + b), and the term competes with
    ln a = ln c - r (t - b + 1). The upper 32
    bits hold a on a fine scale, the lower ones a hash of term, sample and step: two documents share
    a sample only if the same term wins at the same step, which happens with the probability
    of their generalised Jaccard similarity.
    """
    r, b = drawn["r"], drawn["b"]
    # a weight of one is in step 0, as b is below 1; most words of a text stand there once
    t = F.when(log_weight == 0, F.lit(0).cast("long")).otherwise(F.floor(log_weight / r + b))
    ln_a = drawn["ln_c"] - r * (t - b + 1)
    # ln a lies between about -1,000 and 4; below -60 nothing more than order at the edge is lost
    scaled = ((F.greatest(ln_a, F.lit(-60.0)) + 60.0) * float(1 << 25)).cast("long")
    mark = F.xxhash64(drawn["hash"], t).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(scaled, 32).bitwiseOR(mark)


def term_samples(term: Column, weight: Column, samples: int = SAMPLES) -> Column:
    """The samples of a term that is not null with a weight above zero, an array."""
    log_weight = F.ln(weight.cast("double"))
    return F.array(*[
        sample_key(log_weight, draws(F.xxhash64(term, F.lit(2 * i)), F.xxhash64(term, F.lit(2 * i + 1))))
        for i in range(samples)
    ])


def sampled(terms: DataFrame, share: str, key: str, samples: int = SAMPLES) -> DataFrame:
    """``(<share>, <key>, samples)`` from ``terms(<share>, <key>, term, weight)``, terms as 64-bit hashes and
    distinct per key: the signature of every key, an array of ``samples`` numbers. A key whose terms or weights are
    all null or not above zero has nulls for samples.

    The samples of a term depend on its weight alone, so they are drawn once per share, term and weight, and then
    handed to the keys that hold it; what is left per key and term is a minimum. ``share`` says which keys draw
    together: all rows of a key are in one share, and a share is what one task holds. Where rows are placed by share
    nothing is exchanged. The keys gathered behind a term are at most those of the share.
    """
    # the share is last: rows are sorted for the lists, first by a prefix of the first column, and a task has few shares
    pairs = terms.groupBy("term", "weight", share).agg(F.collect_list(key).alias("holders"))
    # part of the result of an aggregate that gathers lists, which Spark compiles by methods: one a sample, not one for all
    drawn = pairs.select(
        share, "holders", (F.col("term").isNotNull() & (F.col("weight") > 0)).alias("taken"),
        term_samples(F.col("term"), F.col("weight"), samples).alias("drawn"),
    )
    held = drawn.select(share, F.explode("holders").alias(key), "taken", "drawn")
    least = held.groupBy(share, key).agg(*[
        F.min(F.when(F.col("taken"), F.get("drawn", F.lit(i)))).alias(f"least_{i}")
        for i in range(samples)
    ])
    return least.select(
        share, key, F.array(*[F.col(f"least_{i}") for i in range(samples)]).alias("samples")
    )


def signatures(terms: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``(<keys>, sig_0 ... )`` from ``terms(<keys>, term, weight)``. Keys draw together by their hash."""
    shares = 4 * int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = terms.select(
        F.pmod(F.xxhash64(*keys), F.lit(shares)).alias("share"), F.struct(*keys).alias("of"),
        "term", "weight",
    )
    return sampled(placed, "share", "of", samples).select(
        "of.*", *[F.get(F.col("samples"), F.lit(i)).alias(f"sig_{i}") for i in range(samples)]
    )


def word_terms(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``(<keys>, term, weight)``: how often each word stands in a text. Where a text begins or
    ends with white space, or has no word, there is a null term, which is never sampled."""
    words = texts.select(*keys, F.explode(F.split(F.col(text), WORD_BREAK)).alias("word"))
    terms = words.select(*keys, F.when(F.col("word") != "", F.xxhash64("word")).alias("term"))
    return terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("weight"))


def likeness(left: Column, right: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples in two signatures: an estimate of the
    generalised Jaccard similarity. Two texts without words are equal (1); one without and one
    with words share nothing (0)."""
    same = F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda e: e))
    none_left, none_right = F.get(left, F.lit(0)).isNull(), F.get(right, F.lit(0)).isNull()
    return F.when(none_left & none_right, 1.0).when(none_left | none_right, 0.0).otherwise(
        same / float(samples)
    )


def fingerprint(signature: Column) -> Column:
    """The samples as text, 8 hex digits each: term and step hashes, which is what decides
    equality. Empty for a text without words."""
    return F.array_join(F.transform(signature, lambda sample: F.lpad(
        F.lower(F.hex(sample.bitwiseAND(F.lit(_LOW)))), 8, "0"
    )), "")


def _range_starts(docs: DataFrame, ranges: int) -> list:
    """Keys that cut the sorted keys into about equal ranges; ``ranges`` values on the driver."""
    cuts = [i / ranges for i in range(1, ranges)]
    found = docs.select(
        F.percentile_approx("id", F.array(*map(F.lit, cuts)), F.lit(10 * ranges)).alias("cuts")
    ).first()["cuts"]
    return sorted(set(found or []))


def successors(docs: DataFrame, ranges: int, scratch: Scratch) -> DataFrame:
    """``(range, place, guest, id, text, next_text)`` from ``docs(id, text)`` with a numeric ``id``: each row
    beside the text of the next one by ascending id (ties by text, null ids first); the last
    one is followed by the first. ``place`` numbers the rows of a range; rows marked ``guest`` are second
    copies of the next range's first rows and have no next text of their own.

    Rows are placed by ranges of the id, so the order is taken within ranges, each of which is
    one of ``ranges`` equal shares of the rows. The first rows of a range are placed in the range
    before as well, behind all of its own: with that the order is whole across ranges, and one
    exchange of the texts does.
    """
    cuts = _range_starts(docs, ranges)
    number = sum(
        ((F.col("id") >= F.lit(cut)).cast("int") for cut in cuts), F.lit(0)
    ) if len(cuts) <= 16 else F.size(F.filter(
        F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col("id")
    ))
    placed = docs.select("id", "text", F.coalesce(number, F.lit(0)).alias("range"))
    firsts = scratch.table(
        "range-firsts",
        placed.groupBy("range").agg(
            F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("first")
        ),
    )
    order = Window.partitionBy(F.lit(0)).orderBy("range")  # one row per range
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ))
    links = scratch.table(
        "range-links",
        firsts.select("range", F.col("first.id").alias("first_id"), before.alias("before")),
    )
    own = placed.join(F.broadcast(links), "range")
    is_first = F.col("id").eqNullSafe(F.col("first_id"))
    homes = F.when(
        is_first, F.array(
            F.struct(F.lit(False).alias("guest"), F.col("range").alias("home")),
            F.struct(F.lit(True).alias("guest"), F.col("before").alias("home")),
        )
    ).otherwise(F.array(
        F.struct(F.lit(False).alias("guest"), F.col("range").alias("home"))
    ))
    rows = own.select("id", "text", F.explode(homes).alias("at")).select(
        "id", "text", "at.guest", F.col("at.home").alias("range")
    )
    by_id = Window.partitionBy("range").orderBy("guest", "id", "text")
    return rows.select(
        "range", F.row_number().over(by_id).alias("place"), "guest", "id", "text",
        F.lead("text").over(by_id).alias("next_text"),
    )


def fingerprint_edits(
    docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES,
    ranges: int | None = None,
) -> DataFrame:
    """``(<key>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``, one row per row
    of ``docs``: every text against its edited form, in which the last half is replaced by the
    beginning of the next document, and against the next document itself.

    Terms are words, weighted by how often they stand in the text. A null text is empty; texts
    without words have an empty fingerprint and are alike (1) to each other only; equal texts
    have equal fingerprints. Repeated rows and rows with equal keys follow each other, ordered by
    text; null keys come first; a key is a number (other kinds fail in the cast). After the range placement nothing is exchanged but one row
    per text for the likeness to the next document: words are counted where the text is.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    plain = docs.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    follow = successors(plain, ranges, scratch)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.length("text") - half),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
    )
    row = ["range", "place"]
    # a text and its edited form stand one after the other: at 2 * place and 2 * place + 1
    texts = follow.select(*row, F.posexplode(F.array("text", edited))).select(
        "range", (F.col("place") * 2 + F.col("pos")).alias("at"), F.col("col").alias("text")
    )
    signed = sampled(word_terms(texts, ["range", "at"]), "range", "at", samples)
    by_at = Window.partitionBy("range").orderBy("at")
    beside = signed.select(
        "range", "at", F.col("samples").alias("own"), F.lead("samples").over(by_at).alias("edited"),
        F.lead("samples", 2).over(by_at).alias("next"),
    )
    own = F.col("own")
    compared = beside.where("at % 2 = 0").withColumn("place", (F.col("at") / 2).cast("int")).select(
        *row, fingerprint(own).alias("fingerprint"),
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        likeness(own, F.col("edited"), samples).alias("near_edited"),
        likeness(own, F.col("next"), samples).alias("near_next"),
    )
    facts = follow.where("not guest").select(
        *row, F.col("id").alias(key), F.length("text").cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
    )
    return facts.join(compared, row).drop(*row)
