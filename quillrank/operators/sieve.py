"""A sieve of fixed size for the terms worth counting, so that most tokens need no stemming."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillrank.functions.porter import may_stem, signs_of_stem

# Places of the sieve, one byte each, whatever the number of terms. With very many terms it lets
# more through, which costs time and changes nothing: terms are selected by a join.
SLOTS = 1 << 18


def _slot(kind: Column, word: Column) -> Column:
    return F.pmod(F.xxhash64(kind, word), F.lit(SLOTS)).cast("int")


class TermSieve:
    """Says of a word that it is no term, or that it may be one; never no of a term."""

    def __init__(self, slots: Iterable[int]):
        places = bytearray(SLOTS)
        for slot in slots:
            places[slot] = 1
        self._places, self._taken = F.lit(bytes(places)), F.lit(b"\x01")

    @classmethod
    def of(cls, terms: DataFrame, column: str = "term") -> TermSieve:
        """The sieve of a column of stems, built by an aggregate: what reaches the driver are
        distinct places, of which there are ``SLOTS``."""
        signs = terms.select(F.explode(signs_of_stem(F.col(column))).alias("s"))
        slots = signs.select(_slot(F.col("s.kind"), F.col("s.word")).alias("slot")).distinct()
        return cls(row.slot for row in slots.collect())

    def _has(self, kind: str, word: Column) -> Column:
        return F.substring(self._places, _slot(F.lit(kind), word) + 1, F.lit(1)) == self._taken

    def may_stem_to_term(self, token: Column) -> Column:
        return may_stem(token, self._has)

    def may_be_term(self, stem: Column) -> Column:
        return self._has("stem", stem)
