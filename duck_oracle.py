"""The registered queries once more, as SQL for DuckDB over the same Parquet tables.

Written apart from the package: nothing is imported from it, so that a slip in a rule or a
formula shows up as a mismatch. Every statement is a list of common table expressions plus a
final select; ``_sql`` adds the expressions a select depends on.
"""

from __future__ import annotations

import re

# The query list of the checks.
QUERY_LIST = (
    "ention edtion", "inging", "lement", "enlich enheit", "on hetion estion", "th", "que lement",
)

# English stopwords that a run of ASCII letters and digits can equal.
_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom this
that these those am is are was were be been being have has had having do does did doing a an
the and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now cannot could ought would
""".split()

# Fixed value: first lines shorter than this are no titles in some checks.
SHORT_TITLE = 60

_CONSONANTS = "[^aeiou][^aeiouy]*"
_VOWELS = "[aeiouy][aeiou]*"
_M1_UP = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}"
_M2_UP = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}{_VOWELS}{_CONSONANTS}"
_M1_ONLY = f"^({_CONSONANTS})?{_VOWELS}{_CONSONANTS}({_VOWELS})?$"
_VOWEL_IN = f"^({_CONSONANTS})?[aeiouy]"
_CVC = f"^{_CONSONANTS}[aeiouy][^aeiouwxy]$"


def _has(expression: str, pattern: str) -> str:
    return f"regexp_matches({expression}, '{pattern}')"


def _stem(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _replace(rules: str, pattern: str) -> str:
    """CASE over ``suffix>replacement`` pairs given longest first."""
    branches = []
    for rule in rules.split():
        suffix, replacement = rule.split(">")
        stem = _stem(len(suffix))
        condition = _has(stem, pattern)
        if suffix == "ion":
            condition += f" AND right({stem}, 1) IN ('s', 't')"
        branches.append(
            f"WHEN ends_with(w, '{suffix}') THEN "
            f"CASE WHEN {condition} THEN {stem} || '{replacement}' ELSE w END"
        )
    return f"CASE {' '.join(branches)} ELSE w END"


# One column w per step; words of one or two letters skip the chain (``short``), and an
# initial y is upper case meanwhile, which makes it a consonant to every pattern.
_PORTER = [
    "CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN " + _stem(2)
    + " WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN " + _stem(1)
    + " ELSE w END",
    f"CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_has(_stem(3), _M1_UP)} "
    f"THEN {_stem(1)} ELSE w END "
    f"WHEN ends_with(w, 'ed') THEN CASE WHEN {_has(_stem(2), _VOWEL_IN)} "
    f"THEN {_stem(2)} || '+' ELSE w END "
    f"WHEN ends_with(w, 'ing') THEN CASE WHEN {_has(_stem(3), _VOWEL_IN)} "
    f"THEN {_stem(3)} || '+' ELSE w END ELSE w END",
    f"CASE WHEN NOT ends_with(w, '+') THEN w "
    f"WHEN right({_stem(1)}, 2) IN ('at', 'bl', 'iz') THEN {_stem(1)} || 'e' "
    f"WHEN length(w) > 2 AND substr(w, length(w) - 1, 1) = substr(w, length(w) - 2, 1) "
    f"AND NOT {_has(_stem(1), '[aeiouylsz]$')} THEN {_stem(2)} "
    f"WHEN {_has(_stem(1), _CVC)} THEN {_stem(1)} || 'e' ELSE {_stem(1)} END",
    f"CASE WHEN ends_with(w, 'y') AND {_has(_stem(1), _VOWEL_IN)} "
    f"THEN {_stem(1)} || 'i' ELSE w END",
    _replace(
        "ational>ate ization>ize iveness>ive fulness>ful ousness>ous tional>tion "
        "biliti>ble entli>ent ousli>ous ation>ate alism>al aliti>al iviti>ive enci>ence "
        "anci>ance izer>ize abli>able alli>al ator>ate eli>e", _M1_UP),
    _replace("icate>ic ative> alize>al iciti>ic ical>ic ness> ful>", _M1_UP),
    _replace(
        "ement> ance> ence> able> ible> ment> ant> ent> ion> ism> ate> iti> ous> ive> ize> "
        "al> er> ic> ou>", _M2_UP),
    f"CASE WHEN ends_with(w, 'e') AND ({_has(_stem(1), _M2_UP)} OR "
    f"({_has(_stem(1), _M1_ONLY)} AND NOT {_has(_stem(1), _CVC)})) "
    f"THEN {_stem(1)} ELSE w END",
    f"CASE WHEN ends_with(w, 'll') AND {_has('w', _M2_UP)} THEN {_stem(1)} ELSE w END",
]


def _porter_ctes() -> dict[str, str]:
    ctes = {
        "stem_0": "SELECT token, CASE WHEN starts_with(token, 'y') "
                  "THEN 'Y' || substr(token, 2) ELSE token END AS w "
                  "FROM vocabulary WHERE length(token) > 2"
    }
    for n, step in enumerate(_PORTER, 1):
        ctes[f"stem_{n}"] = f"SELECT token, {step} AS w FROM stem_{n - 1}"
    ctes["stems"] = (
        f"SELECT token, lower(w) AS stem FROM stem_{len(_PORTER)} "
        "UNION ALL SELECT token, token FROM vocabulary WHERE length(token) <= 2"
    )
    return ctes


def _tokens(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '[A-Za-z0-9]+'), lambda x: lower(x))"


def _content(text: str) -> str:
    words = ", ".join(f"'{word}'" for word in _STOPWORDS)
    return f"list_filter({_tokens(text)}, lambda x: x NOT IN ({words}))"


_FIXED_QUERIES = "SELECT * FROM (VALUES {}) AS v(original_query)".format(
    ", ".join(f"('{query}')" for query in QUERY_LIST)
)
_BENCHMARK_QUERIES = "SELECT unnest(string_split(text, chr(10))) AS original_query FROM benchmark"

# In order of dependency.
_CTES: dict[str, str] = {
    "query_lines": _FIXED_QUERIES,
    "articles": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, lines[1] AS title, lines[2:] AS items
        FROM (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents)""",
    "bodies": """
        SELECT *, list_filter(items, lambda x: trim(x) <> '') AS paragraphs,
               array_to_string(list_filter(items, lambda x: trim(x) <> '')[1:5], ' ') AS body
        FROM articles""",
    "doc_tokens": f"""
        SELECT doc_id, title, list_concat({_content('title')}, {_content('body')}) AS tokens
        FROM bodies""",
    "lengths": "SELECT doc_id, title, CAST(len(tokens) AS BIGINT) AS dl FROM doc_tokens",
    "doc_words": """
        SELECT doc_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token
        FROM doc_tokens""",
    "queries": """
        SELECT original_query AS query_id, count(*) AS n_lines
        FROM query_lines GROUP BY original_query""",
    "query_words": f"""
        SELECT query_id, n_lines, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token
        FROM (SELECT query_id, n_lines, {_content('query_id')} AS tokens FROM queries)""",
    "vocabulary": "SELECT token FROM doc_words UNION SELECT token FROM query_words",
    **_porter_ctes(),
    "query_terms": """
        SELECT query_id, n_lines, pos, stem AS term FROM query_words JOIN stems USING (token)""",
    "postings": """
        SELECT query_id, term, n_lines, sum(count(*)) OVER (PARTITION BY query_id) AS n_terms
        FROM query_terms GROUP BY query_id, term, n_lines""",
    "doc_freq": """
        SELECT doc_id, stem AS term, count(*) AS tf
        FROM doc_words JOIN stems USING (token)
        WHERE stem IN (SELECT term FROM postings) GROUP BY doc_id, stem""",
    "matched": """
        SELECT query_id, doc_id, term, tf, n_terms FROM doc_freq JOIN postings USING (term)""",
    "stats": """
        SELECT count(*) AS n_docs, CAST(sum(dl) AS BIGINT) AS total_len,
               CAST(sum(dl) AS DOUBLE) / count(*) AS avgdl FROM lengths""",
    "cf_corpus": "SELECT term, CAST(sum(tf) AS BIGINT) AS cf FROM doc_freq GROUP BY term",
    "cf_per_query": """
        SELECT term, CAST(cf * n AS BIGINT) AS cf FROM cf_corpus
        JOIN (SELECT term, sum(n_lines) AS n FROM postings GROUP BY term) USING (term)""",
    "cf": "SELECT * FROM cf_per_query",
    "candidates": """
        SELECT query_id, doc_id, term, tf, dl, n_terms, title
        FROM matched JOIN lengths USING (doc_id) WHERE title IS NOT NULL""",
    "dph_input": """
        SELECT c.*, cf.cf, n_docs, avgdl, CAST(n_docs // cf.cf AS DOUBLE) AS ratio,
               CASE WHEN tf < dl THEN CAST(tf AS DOUBLE) / dl ELSE 0.99999 END AS f
        FROM candidates c JOIN cf USING (term) CROSS JOIN stats""",
    "dph_terms": """
        SELECT query_id, doc_id, title, term, tf, n_terms,
               (1 - f) * (1 - f) / (tf + 1)
               * (tf * CASE WHEN ratio > 0 THEN log2(tf * avgdl / dl * ratio)
                            ELSE CAST('-inf' AS DOUBLE) END
                  + 0.5 * log2(2 * pi() * tf * (1 - f))) AS dph
        FROM dph_input""",
    "scores": """
        SELECT query_id, doc_id, title, sum(dph) / n_terms AS score
        FROM dph_terms GROUP BY query_id, doc_id, title, n_terms""",
    "ranked": """
        SELECT *, row_number() OVER (
            PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
        FROM scores""",
    # DuckDB's levenshtein counts bytes: one control character stands for each character
    # beyond ASCII, so that bytes are characters.
    "wide": """
        SELECT string_agg(c, '' ORDER BY c) AS chars,
               string_agg(chr(CAST(CASE WHEN n <= 8 THEN n ELSE n + 5 END AS INTEGER)), ''
                          ORDER BY c) AS marks
        FROM (SELECT c, row_number() OVER (ORDER BY c) AS n
              FROM (SELECT DISTINCT unnest(string_split(
                        title || coalesce(paragraphs[1], ''), '')) AS c FROM bodies)
              WHERE unicode(c) > 127)""",
    "narrow_titles": """
        SELECT doc_id, coalesce(translate(title, chars, marks), title) AS narrow
        FROM articles CROSS JOIN wide""",
    "line_up": """
        SELECT r.*, narrow FROM ranked r JOIN narrow_titles USING (doc_id)""",
    "walk": """
        SELECT DISTINCT query_id, CAST(0 AS BIGINT) AS rank, CAST([] AS VARCHAR[]) AS titles,
               CAST([] AS VARCHAR[]) AS kept
        FROM line_up
        UNION ALL
        SELECT query_id, rank, CASE WHEN close THEN titles ELSE list_append(titles, narrow) END,
               CASE WHEN close THEN kept ELSE list_append(kept, doc_id) END
        FROM (SELECT w.query_id, r.rank, w.titles, w.kept, r.doc_id, r.narrow,
                     len(list_filter(w.titles, lambda t:
                         CASE WHEN greatest(length(t), length(r.narrow)) = 0
                                OR 2 * abs(length(t) - length(r.narrow))
                                   >= greatest(length(t), length(r.narrow)) THEN false
                              ELSE 2 * levenshtein(t, r.narrow)
                                   < greatest(length(t), length(r.narrow)) END)) > 0 AS close
              FROM walk w JOIN line_up r ON r.query_id = w.query_id AND r.rank = w.rank + 1
              WHERE len(w.kept) < 10)""",
    "kept": """
        SELECT query_id, generate_subscripts(kept, 1) AS rank, unnest(kept) AS doc_id
        FROM (SELECT query_id, arg_max(kept, rank) AS kept FROM walk GROUP BY query_id)""",
    "rankings": """
        SELECT k.query_id, k.rank, k.doc_id, s.score, s.title
        FROM kept k JOIN scores s ON s.query_id = k.query_id AND s.doc_id = k.doc_id""",
    "texts": """
        SELECT query_id, query_id || chr(10) || string_agg(
                   '  ' || rank || ':' || doc_id || ' '
                   || CASE WHEN isinf(score) THEN '-Infinity' ELSE printf('%.6f', score) END
                   || ' ' || title || chr(10), '' ORDER BY rank) AS ranking
        FROM rankings GROUP BY query_id""",
}


def _sql(select: str, **overrides: str) -> str:
    ctes = {**_CTES, **overrides}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in ctes and name not in needed:
                needed.add(name)
                visit(ctes[name])

    visit(select)
    if not needed:
        return select
    parts = ",\n".join(f"{name} AS ({text.strip()})" for name, text in ctes.items() if name in needed)
    return f"WITH RECURSIVE {parts}\n{select}"


_SCORE = (
    "CASE WHEN isinf(score) THEN NULL ELSE round(score, 6) END AS score, "
    "isinf(score) AS score_unbounded"
)
_DPH = (
    "CASE WHEN isinf(dph) THEN NULL ELSE round(dph, 6) END AS dph, isinf(dph) AS dph_unbounded"
)
_RANKED = f"SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, {_SCORE}, title FROM rankings"
# The fields of an item of an article, in order.
_ITEM_FIELDS = (
    "content subtype type mime fullcaption imageURL imageHeight imageWidth blurb role name bio "
    "kicker"
).split()
_ITEM = " || '|' || ".join(
    {"content": "x", "subtype": "CASE WHEN trim(x) <> '' THEN 'paragraph' ELSE '-' END"}.get(
        name, f"'{name} of ' || doc_id") for name in _ITEM_FIELDS
)
_ARTICLE_COLUMNS = (
    "SELECT doc_id AS id, title, source, CAST(len(items) AS BIGINT) AS n_items, "
    "array_to_string(items, chr(10)) AS items_text FROM articles"
)
_EXACT = {
    "query_lines": _BENCHMARK_QUERIES,
    "cf": "SELECT * FROM cf_corpus",
    "dph_input": _CTES["dph_input"].replace("n_docs // cf.cf", "n_docs / cf.cf"),
}


def oracle_sql() -> dict[str, str]:
    return {
        "src_queries": _sql(
            "SELECT query_id, query_id AS original_query, n_lines FROM queries",
            query_lines=_BENCHMARK_QUERIES),
        "query_parse": _sql(
            "SELECT query_id AS original_query, "
            "coalesce(string_agg(term, ' ' ORDER BY pos), '') AS query_terms, "
            "count(term) AS n_counts FROM queries LEFT JOIN query_terms USING (query_id) "
            "GROUP BY query_id",
            query_lines=_BENCHMARK_QUERIES),
        "src_articles": _sql(_ARTICLE_COLUMNS),
        "article_parse": _sql(_ARTICLE_COLUMNS),
        "paragraph_filter": _sql(
            "SELECT doc_id, CAST(len(items) AS BIGINT) AS n_items, "
            "CAST(len(paragraphs) AS BIGINT) AS n_paragraphs, "
            "array_to_string(paragraphs, chr(10)) AS paragraphs_text FROM bodies"),
        "first_paragraphs": _sql(
            "SELECT doc_id, CAST(len(paragraphs[1:5]) AS BIGINT) AS n_first, "
            "array_to_string(paragraphs[1:5], chr(10)) AS first_text FROM bodies"),
        "body_text": _sql("SELECT doc_id, body FROM bodies"),
        "tokenise": (
            "SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, "
            "array_to_string(tokens, ' ') AS tokens FROM "
            f"(SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_tokens('text')} AS tokens "
            "FROM documents)"),
        "remove_stopwords": (
            "SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, "
            "array_to_string(tokens, ' ') AS tokens FROM "
            f"(SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_content('text')} AS tokens "
            "FROM documents)"),
        "porter_stem": _sql(
            "SELECT token, stem FROM stems",
            doc_words=f"SELECT unnest({_content('text')}) AS token FROM documents",
            query_words="SELECT unnest(CAST([] AS VARCHAR[])) AS token"),
        "doc_terms": _sql(
            "SELECT doc_id, coalesce(string_agg(stem, ' ' ORDER BY pos), '') AS terms "
            "FROM doc_tokens LEFT JOIN doc_words USING (doc_id) LEFT JOIN stems USING (token) "
            "GROUP BY doc_id"),
        "doc_length": _sql("SELECT doc_id, dl FROM lengths"),
        "corpus_stats": _sql(
            "SELECT n_docs, total_len, round(avgdl, 6) AS avgdl FROM stats"),
        "query_doc_match": _sql("SELECT DISTINCT query_id, doc_id FROM matched"),
        "term_freq": _sql("SELECT query_id, doc_id, term, tf FROM matched"),
        "term_freq_map": _sql(
            "SELECT query_id, doc_id, string_agg(term || '=' || tf, ' ' ORDER BY term) "
            "AS term_freq FROM matched GROUP BY query_id, doc_id"),
        "corpus_term_freq": _sql(
            "SELECT p.term, p.cf AS cf_per_query, c.cf AS cf_corpus "
            "FROM cf_per_query p JOIN cf_corpus c USING (term)"),
        "candidates": _sql("SELECT query_id, doc_id, term, tf, dl FROM candidates"),
        "term_stats_join": _sql(
            "SELECT query_id, doc_id, term, tf, dl, cf FROM candidates JOIN cf USING (term)"),
        "dph_term_score": _sql(f"SELECT query_id, doc_id, term, tf, {_DPH} FROM dph_terms"),
        "dph_scores": _sql(f"SELECT query_id, doc_id, {_SCORE} FROM scores"),
        "rank_in_query": _sql(f"SELECT query_id, rank, doc_id, {_SCORE} FROM ranked"),
        "topk_before_dedup": _sql(
            f"SELECT query_id, rank, doc_id, {_SCORE}, title FROM ranked WHERE rank <= 10"),
        "title_distance": _sql(
            "SELECT doc_id, round(CAST(levenshtein(a, b) AS DOUBLE) "
            "/ nullif(greatest(length(a), length(b)), 0), 6) AS distance FROM ("
            "SELECT doc_id, coalesce(translate(title, chars, marks), title) AS a, "
            "coalesce(translate(coalesce(paragraphs[1], ''), chars, marks), "
            "coalesce(paragraphs[1], '')) AS b FROM bodies CROSS JOIN wide)"),
        "ranked_title_distance": _sql(
            "SELECT a.query_id, a.rank, b.rank AS other_rank, "
            "round(CAST(levenshtein(s.narrow, t.narrow) AS DOUBLE) "
            "/ nullif(greatest(length(s.narrow), length(t.narrow)), 0), 6) AS distance "
            "FROM kept a JOIN kept b ON a.query_id = b.query_id AND a.rank < b.rank "
            "JOIN narrow_titles s ON s.doc_id = a.doc_id "
            "JOIN narrow_titles t ON t.doc_id = b.doc_id"),
        "near_title_pairs": _sql(
            "SELECT l.query_id, l.doc_id, k.doc_id AS kept_doc_id FROM line_up l "
            "JOIN kept k ON k.query_id = l.query_id AND k.doc_id <> l.doc_id "
            "JOIN narrow_titles t ON t.doc_id = k.doc_id "
            "WHERE 2 * levenshtein(l.narrow, t.narrow) "
            "< greatest(length(l.narrow), length(t.narrow))"),
        "dedup_topk": _sql("SELECT query_id, rank, doc_id FROM rankings"),
        "rank_documents": _sql(
            "SELECT query_id, query_id AS original_query, CAST(rank AS BIGINT) AS rank, doc_id, "
            f"{_SCORE}, title FROM rankings"),
        "rank_benchmark": _sql(_RANKED, **_EXACT),
        "rank_deep": _sql(_RANKED),
        "rank_many_queries": _sql(_RANKED, **_EXACT | {
            "query_lines": "SELECT string_split(text, chr(10))[1] AS original_query FROM documents",
            "walk": _CTES["walk"].replace("len(w.kept) < 10", "len(w.kept) < 3")}),
        "rank_untitled": _sql(_RANKED, articles=_CTES["articles"].replace(
            "lines[1] AS title",
            f"CASE WHEN length(lines[1]) >= {SHORT_TITLE} THEN lines[1] END AS title")),
        "rank_job": _sql(_RANKED, articles=_CTES["articles"] + (
            f" WHERE length(lines[1]) >= {SHORT_TITLE}")),
        "article_fields": _sql(
            "SELECT a.doc_id AS id, 'http://site/' || a.doc_id AS article_url, title, "
            "lang AS author, n_chars * 1000 AS published_date, 'article' AS type, a.source, "
            "items FROM (SELECT doc_id, source, title, array_to_string(list_transform(items, "
            f"lambda x: {_ITEM}), chr(10)) AS items FROM articles) a "
            "JOIN documents d ON a.doc_id = CAST(d.doc_id AS VARCHAR)"),
        "article_quarantine": _sql(
            "SELECT doc_id, CASE WHEN short THEN 'corrupt' ELSE 'article' END AS kind, "
            "CASE WHEN NOT short THEN title END AS title, "
            "CAST(count_if(short) OVER () AS BIGINT) AS n_corrupt "
            f"FROM (SELECT *, length(title) < {SHORT_TITLE} AS short FROM articles)"),
        "ranking_nested": _sql(
            "SELECT query_id, count(*) AS n_results, string_agg(doc_id, ' ' ORDER BY rank) "
            "AS doc_ids, string_agg(title, chr(10) ORDER BY rank) AS titles "
            "FROM rankings GROUP BY query_id"),
        "ranking_text": _sql(
            "SELECT query_id AS original_query, replace(query_id, ' ', '_') AS query_file, "
            "ranking FROM texts"),
        "ranking_files": _sql(
            "SELECT replace(query_id, ' ', '_') AS query_file, "
            "unnest(string_split(left(ranking, length(ranking) - 1), chr(10))) AS line "
            "FROM texts"),
    }
