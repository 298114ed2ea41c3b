"""Porter's suffix-stripping algorithm (M. F. Porter, "An algorithm for suffix stripping",
Program 14(3), 1980) as column expressions.

Each step is one ``transform`` over an array of words, so that the word a step works on is
bound once however many rules look at it, and no step is inlined into the next. A rule tests
the suffix first (cheap) and evaluates its condition on the remaining stem only on a hit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillrank.functions.sqltext import is_one_of, map_items

# A word is [C](VC){m}[V]. ``y`` is a vowel after a consonant and a consonant elsewhere, and
# a leading consonant run is matched possessively so that an initial ``y`` cannot be a vowel.
_C = "[^aeiou][^aeiouy]*+"
_V = "[aeiouy][aeiou]*+"
_HEAD = f"^(?:{_C})?+"
_M_GT_0 = f"{_HEAD}{_V}{_C}"
_M_GT_1 = f"{_HEAD}{_V}{_C}{_V}{_C}"
_M_EQ_1 = f"{_HEAD}{_V}{_C}(?:{_V})?+$"
_HAS_VOWEL = f"{_HEAD}[aeiouy]"
_SHORT_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"  # m = 1 and ends consonant-vowel-consonant

# The rule tables of the published algorithm, suffix and replacement.
_STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
_STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

# Marks at the end of a word while it passes through the steps; no token ends in one.
_SHORT = "\u0001"  # one or two letters: no rule may see it
_CUT = "\u0002"  # lost -ed or -ing: the next step repairs it


def _cut(n: int, word: str = "x") -> str:
    return f"left({word}, length({word}) - {n})"


def _ends(*suffixes: str, word: str = "x") -> str:
    return "(" + " OR ".join(f"endswith({word}, '{suffix}')" for suffix in suffixes) + ")"


def _like(word: str, pattern: str) -> str:
    return f"rlike({word}, '{pattern}')"


def _case(*branches: tuple[str, str], otherwise: str = "x") -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {otherwise} END"


def _suffix_rule(suffix: str, replacement: str, allowed: str) -> tuple[str, str]:
    """On the suffix: replace it where the stem allows, keep the word where not. Either way
    no shorter suffix is tried."""
    stem = _cut(len(suffix))
    new = f"concat({stem}, '{replacement}')" if replacement else stem
    return _ends(suffix), _case((allowed.format(stem=stem), new))


def _suffix_table(rules: Iterable[tuple[str, str]], allowed: Callable[[str], str]) -> str:
    """Longest suffix first. Most words end like none of the suffixes, which their last two
    letters tell."""
    rules = sorted(rules, key=lambda rule: -len(rule[0]))
    endings = sorted({suffix[-2:] for suffix, _ in rules})
    return _case(
        (f"NOT {is_one_of('right(x, 2)', endings)}", "x"),
        *[_suffix_rule(suffix, new, allowed(suffix)) for suffix, new in rules],
    )


def _steps() -> list[str]:
    stem, measured = "{stem}", _like("{stem}", _M_GT_0)
    plurals = _case(
        ("length(x) <= 2", f"concat(x, '{_SHORT}')"),
        (_ends("sses", "ies"), _cut(2)),
        (_ends("s") + " AND NOT " + _ends("ss"), _cut(1)),
    )
    past_and_ing = _case(
        (_ends("eed"), _case((_like(_cut(3), _M_GT_0), _cut(1)))),
        *[
            (_ends(suffix),
             _case((_like(_cut(len(suffix)), _HAS_VOWEL),
                    f"concat({_cut(len(suffix))}, '{_CUT}')")))
            for suffix in ("ed", "ing")
        ],
    )
    bare = _cut(1)
    repair = _case(
        (f"NOT {_ends(_CUT)}", "x"),
        (_ends("at", "bl", "iz", word=bare), f"concat({bare}, 'e')"),
        # a double consonant other than ll, ss, zz
        (f"substr(x, -2, 1) = substr(x, -3, 1) AND {_like(bare, '[^aeiouylsz]$')}", _cut(2)),
        (_like(bare, _SHORT_CVC), f"concat({bare}, 'e')"),
        otherwise=bare,
    )
    final_y = _case((f"{_ends('y')} AND {_like(bare, _HAS_VOWEL)}", f"concat({bare}, 'i')"))
    long_stem = _like(stem, _M_GT_1)
    after_s_or_t = f"{long_stem} AND {_ends('s', 't', word=stem)}"
    step_2 = _suffix_table(_STEP_2, lambda suffix: measured)
    step_3 = _suffix_table(_STEP_3, lambda suffix: measured)
    step_4 = _suffix_table(
        [(suffix, "") for suffix in _STEP_4],
        lambda suffix: after_s_or_t if suffix == "ion" else long_stem,
    )
    lone = f"{_like(bare, _M_EQ_1)} AND NOT {_like(bare, _SHORT_CVC)}"
    final_e = _case((f"{_ends('e')} AND ({_like(bare, _M_GT_1)} OR {lone})", bare))
    final_ll = _case(
        (f"{_ends(_SHORT)} OR ({_ends('ll')} AND {_like('x', _M_GT_1)})", bare)
    )
    return [plurals, past_and_ing, repair, final_y, step_2, step_3, step_4, final_e, final_ll]


_STEPS = _steps()


def stem_words(words: Column) -> Column:
    """Stem every word of an array of lower-case words."""
    for step in _STEPS:
        words = map_items(words, step)
    return words


def may_change(word: str) -> str:
    """False for words that are their own stems, as they end like nothing that a rule looks at or have two
    letters at most; a condition as text. A word that the first rules leave alone reaches the next ones as it is."""
    endings = {suffix[-2:] for suffix, _ in (*_STEP_2, *_STEP_3)} | {suffix[-2:] for suffix in _STEP_4}
    two = is_one_of(f"right({word}, 2)", sorted(endings | {"ed", "ng", "ll"}))
    return f"length({word}) > 2 AND (right({word}, 1) IN ('s', 'y', 'e') OR {two})"


def stem_word(word: Column) -> Column:
    """Stem one lower-case word."""
    return F.get(stem_words(F.array(word)), F.lit(0))


# What is sure about a word from its stem. The rules only cut at the end of a word or rewrite
# what they cut, and they ask for a vowel in what is left but for the plural one. A rewritten letter
# survives to the end in three cases only: an ``e`` put back for -ed or -ing, an ``i`` for ``y``, the ``l`` of
# ``bl`` for -bility. So a word begins with its stem or with one of the forms below, a stem without vowels is the
# word or its plural, and only -es, -ed and -ing leave a single vowel.
_OTHER_ENDS = (("e", "i"), ("i", "y"), ("bl", "i"))
_PREFIX = 5  # letters of a beginning that are looked at


def signs_of_stem(stem: Column) -> Column:
    """``array<struct<kind, word>>``: what ``may_stem`` asks for, for the words of one stem. ``start``: the
    first letters of its words; ``word``: all of its words; ``two``: the first two letters of either;
    ``stem``: itself."""
    def sign(kind: str, word: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), word.alias("word"))

    def signs(kind: str, words: list[Column]) -> Column:
        return F.array(*[
            s for w in words for s in (sign(kind, w), sign("two", F.left(w, F.lit(2))))
        ])

    def followed_by(*ends: str) -> list[Column]:
        return [F.concat(stem, F.lit(end)) for end in ends]

    rest = F.substring(stem, F.lit(1), F.length(stem) - 1)
    other = F.coalesce(*[
        F.when(F.endswith(stem, F.lit(end)), F.concat(rest, F.lit(new)))
        for end, new in _OTHER_ENDS
    ], stem)
    starts = [F.left(beginning, F.lit(_PREFIX)) for beginning in (stem, other)]
    return F.concat(
        F.array(sign("stem", stem)),
        F.when(~stem.rlike("[aeiouy]"), signs("word", followed_by("", "s", "es")))
        .when(F.length(stem) == 1, signs("word", followed_by("", "es", "ed", "ing", "eds", "ings")))
        .otherwise(signs("start", starts)),
    )


def may_stem(word: Column, has: Callable[[str, Column], Column]) -> Column:
    """Necessary for the stem of ``word`` to be one of those whose signs ``has(kind, word)`` knows.
    Cheap: most words already differ from all of them in the first two letters."""
    longer = has("word", word)
    for n in range(2, _PREFIX + 1):
        longer = longer | has("start", F.left(word, F.lit(n)))
    return has("two", F.left(word, F.lit(2))) & longer


def _sure_prefix(stem: str) -> str:
    sure = stem[:-1] if stem.endswith(("e", "i", "bl")) else stem
    return (sure or stem)[:_PREFIX]


def may_stem_to(stems: Iterable[str]) -> str:
    """Condition as text over ``x``, necessary for the stem of ``x`` to be one of ``stems``, for a few stems
    that are known beforehand: the word starts like one of them."""
    words: set[str] = set()
    by_length: dict[int, set[str]] = {}
    for stem in stems:
        if set(stem) & set("aeiouy"):
            prefix = _sure_prefix(stem)
            by_length.setdefault(len(prefix), set()).add(prefix)
        else:
            words.update((stem, stem + "s", stem + "es"))
    tests = [is_one_of(f"left(x, {n})", sorted(by_length[n])) for n in sorted(by_length)]
    if words:
        tests.append(is_one_of("x", sorted(words)))
    return f"({' OR '.join(tests)})" if tests else "false"
