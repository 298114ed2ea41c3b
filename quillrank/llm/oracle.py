"""The corpus operators in DuckDB SQL, where SQL can say them."""

from __future__ import annotations

_SPACE = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT row_id, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
    FROM (SELECT row_number() OVER () AS row_id, doc_id,
                 string_split(coalesce(text, ''), chr(10)) AS ls
          FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {_SPACE}), {_UPPER}) AS key FROM lines
), frequent AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT row_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN frequent f USING (key)
GROUP BY row_id, doc_id
"""

CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), escaped AS (
    SELECT *, length(replace(replace(text, chr(92), repeat(chr(92), 2)), '<|', '<' || chr(92) || '|'))
        + length(replace(replace(replace(role, chr(92), repeat(chr(92), 2)), '<|', '<' || chr(92) || '|'),
                 chr(10), chr(92) || 'n'))
        + length('<|im_start|>') + length('<|im_end|>') + 2 AS size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
           AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM escaped
GROUP BY conv_id
"""


# Fixed values of the mixture: seed, weights, share of the tokens, most epochs.
_WEIGHTS = {
    1: "CASE domain WHEN 'long' THEN 3.0 WHEN 'medium' THEN 2.0 ELSE 1.0 END",
    2: "CASE WHEN lang = 'en' THEN 3.0 ELSE 1.0 END",
    3: "1.0",
}
_LEVELS = ("domain", "lang", "source")


def _poured(depth: int) -> str:
    """The budgets of the nodes of one level, from those of the level above."""
    path, parent = ", ".join(_LEVELS[:depth]), ", ".join(_LEVELS[:depth - 1]) or "true"
    above = f"JOIN level_{depth - 1} USING ({parent})" if depth > 1 else "CROSS JOIN level_0"
    order = f"(PARTITION BY {parent} ORDER BY capacity / weight, name)"
    return f"""nodes_{depth} AS (
    SELECT *, {_WEIGHTS[depth]}::DOUBLE AS weight, {_LEVELS[depth - 1]} AS name
    FROM (SELECT {path}, sum(tokens)::DOUBLE * 2.0 AS capacity FROM leaves GROUP BY {path})
    {above}
), levels_{depth} AS (
    SELECT *, (budget - (sum(capacity) OVER {order} - capacity))
              / (sum(weight) OVER (PARTITION BY {parent})
                 - (sum(weight) OVER {order} - weight)) AS level
    FROM nodes_{depth}
), open_{depth} AS (
    SELECT *, first_value(CASE WHEN capacity / weight > level THEN level END IGNORE NULLS) OVER (
        PARTITION BY {parent} ORDER BY capacity / weight, name
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS water
    FROM levels_{depth}
), level_{depth} AS (
    SELECT {path}, greatest(0.0, least(capacity, coalesce(water * weight, capacity))) AS budget
    FROM open_{depth}
)"""


MIXING = f"""
WITH sized AS (
    SELECT doc_id, CASE WHEN n_chars >= 5000 THEN 'long' WHEN n_chars >= 1000 THEN 'medium'
                        ELSE 'short' END AS domain,
           coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)
               AS n_tokens
    FROM documents
), leaves AS (
    SELECT domain, lang, source, sum(n_tokens) AS tokens FROM sized GROUP BY ALL
), level_0 AS (
    SELECT least(sum(tokens) * 0.5, sum(tokens) * 2.0)::DOUBLE AS budget FROM leaves
), {', '.join(_poured(depth) for depth in (1, 2, 3))}, budgets AS (
    SELECT domain, lang, source, tokens, round(budget, 3) AS given,
           CASE WHEN tokens > 0 THEN floor(round(budget, 3) / tokens) ELSE 0 END AS epochs
    FROM leaves JOIN level_3 USING (domain, lang, source)
), placed AS (
    SELECT s.*, CAST(epochs AS BIGINT) AS epochs, floor(given - epochs * tokens) AS rest,
           left(md5('17:' || CAST(epochs AS BIGINT) || ':' || doc_id), 12) AS place
    FROM sized s JOIN budgets USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, n_tokens,
       epochs + CASE WHEN sum(n_tokens) OVER (
           PARTITION BY domain, lang, source ORDER BY place) <= rest THEN 1 ELSE 0 END AS copies
FROM placed
"""

_CRC_STEP = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
_SPACES = r"\x20\x09-\x0D"


def _plus(way: str, cost: str, letter: str, line: str = "''") -> str:
    """A way (cost, audit, text) with one edit more."""
    return (
        f"{{'c': {way}.c + {cost}, 'a': {way}.a || '{letter}', 't': {way}.t || {line}}}"
    )


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _gap(w: str) -> str:
    """The best ways after the insertions before a row, from the best ways ``w0, ws, wu, wa``."""
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    pair = f"{user} || {assistant}"
    to_u = [_plus(f"{w}{q}", "3", "I", user) for q in ("0", "s", "a")]
    to_a = [_plus(f"{w}u", "3", "I", assistant)] + [
        _plus(f"{w}{q}", "6", "II", pair) for q in ("0", "s")
    ]
    return (
        f"{w}0 AS g0, {w}s AS gs, {_least(f'{w}u', *to_u)} AS gu, "
        f"{_least(f'{w}a', *to_a)} AS ga"
    )


def _row(state: str, role: str, sources: list[str]) -> str:
    """The best way to a state over a row: deleted, or kept or given the role where it may stay."""
    kept = [_plus(f"g{q}", "more", "K", "chr(10) || role || ':' || text") for q in sources]
    named = [
        _plus(f"g{q}", "3 + more", "R", f"chr(10) || '{role}:' || text") for q in sources
    ]
    stay = f"CASE WHEN NOT stays THEN [] WHEN x = '{state}' THEN [{', '.join(kept)}] "
    stay += f"ELSE [{', '.join(named) if role else ''}] END"
    return f"list_sort(list_concat([{_plus(f'g{state}', '4', 'D')}], {stay}))[1]"


def _crc32(text: str) -> str:
    """Of ASCII text."""
    return f"""xor(list_reduce(
        list_concat([4294967295::BIGINT],
                    list_transform(string_split({text}, ''), lambda b: ascii(b)::BIGINT)),
        lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                 lambda x, n: {_CRC_STEP})), 4294967295::BIGINT)"""


PERIODIC_RUNS = f"""
WITH split AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^{_SPACES}]+') AS words,
           {_crc32("CAST(doc_id AS VARCHAR)")} AS h
    FROM documents
), sized AS (
    SELECT *, len(words) AS n, h // 10 AS g FROM split
), planned AS (
    SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM sized
), planted AS (
    SELECT row_id, doc_id, n, CASE WHEN a = n THEN words ELSE list_transform(range(n), lambda i:
        words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
        END AS words
    FROM planned
), told AS (
    SELECT row_id, n, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM planted
), equal AS (
    SELECT a.row_id, a.pos, b.pos - a.pos AS period
    FROM told a JOIN told b ON a.row_id = b.row_id AND a.word = b.word
    WHERE b.pos > a.pos AND 4 * (b.pos - a.pos) <= a.n
), stretches AS (
    SELECT row_id, period, min(pos) AS start, count(*) + period AS length
    FROM (SELECT *, pos - row_number() OVER (PARTITION BY row_id, period ORDER BY pos) AS island
          FROM equal)
    GROUP BY row_id, period, island
    HAVING count(*) + period >= greatest(6, 4 * period)
), runs AS (
    SELECT * FROM stretches s WHERE NOT EXISTS (
        SELECT 1 FROM stretches t WHERE t.row_id = s.row_id AND t.period < s.period
        AND t.start <= s.start AND t.start + t.length >= s.start + s.length)
), listed AS (
    SELECT row_id, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), ''
                      ORDER BY start, period) AS lines
    FROM runs GROUP BY row_id
), strongest AS (
    SELECT * FROM runs QUALIFY row_number() OVER (
        PARTITION BY row_id ORDER BY length / period DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT row_id, unnest(range(start + period, start + length)) AS pos FROM runs
), collapsed AS (
    SELECT row_id, string_agg(word, ' ' ORDER BY pos) AS words
    FROM told ANTI JOIN dropped USING (row_id, pos) GROUP BY row_id
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.start AS BIGINT) AS start,
       CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
       CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(c.words, '')) AS collapsed_sha256
FROM planted p LEFT JOIN listed l ON l.row_id = p.row_id
LEFT JOIN strongest b ON b.row_id = p.row_id LEFT JOIN collapsed c ON c.row_id = p.row_id
"""

_NO_WAY = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"

CONVERSATION_REPAIR = f"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':'
           || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), hashed AS (
    SELECT *, {_crc32('name')} % 20 AS kind
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                     ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE kind <> 0
), told AS (
    SELECT *, left(role, 1) AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
               AS i,
           CASE WHEN NOT regexp_matches(text, '[^{_SPACES}]') THEN 'b'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text
                                        ORDER BY turn NULLS FIRST, copy) > 1 THEN 'd'
                WHEN NOT regexp_matches(text, '[.!?][{_SPACES}]*$') THEN 't' ELSE ' ' END AS fault
    FROM damaged
), line_up AS (
    SELECT *, fault NOT IN ('b', 'd') AS stays, CASE WHEN fault = 't' THEN 3 ELSE 0 END AS more,
           lag(x) OVER (PARTITION BY conv_id ORDER BY i) || x NOT IN ('su', 'ua', 'au') AS illegal
    FROM told
), walk AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS w0,
           {_NO_WAY} AS ws, {_NO_WAY} AS wu, {_NO_WAY} AS wa
    FROM conversations
    UNION ALL
    SELECT conv_id, i, {_plus('g0', '4', 'D')},
           list_sort(list_concat([{_plus('gs', '4', 'D')}], CASE WHEN stays AND x = 's'
               THEN [{_plus('g0', 'more', 'K', "chr(10) || role || ':' || text")}] ELSE [] END))[1],
           {_row('u', 'user', ['0', 's', 'a'])}, {_row('a', 'assistant', ['u'])}
    FROM (SELECT l.*, {_gap('w.w')}
          FROM walk w JOIN line_up l
          ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.i = w.i + 1)
), ends AS (
    SELECT conv_id, {_least('g0', 'ga')} AS best
    FROM (SELECT conv_id, {_gap('w')}
          FROM (SELECT conv_id, unnest(max_by(struct_pack(w0, ws, wu, wa), i)) FROM walk
                GROUP BY conv_id))
), facts AS (
    SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
           count_if(fault = 'b') AS blank, count_if(fault = 'd') AS duplicate,
           count_if(fault = 't') AS truncated, count_if(illegal) AS illegal
    FROM line_up GROUP BY conv_id
)
SELECT e.conv_id, coalesce(CAST(gaps AS BIGINT), 0) AS gaps,
       coalesce(CAST(blank AS BIGINT), 0) AS blank,
       coalesce(CAST(duplicate AS BIGINT), 0) AS duplicate,
       coalesce(CAST(truncated AS BIGINT), 0) AS truncated,
       coalesce(CAST(illegal AS BIGINT), 0) AS illegal,
       best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
FROM ends e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def oracle_sql():
    return {
        "op7_mixing": MIXING,
        "op11_periodic_runs": PERIODIC_RUNS,
        "op13_lightest_repair": CONVERSATION_REPAIR,
        "op5_chat_format": CHAT_FORMAT,
        "op6_line_dedup": LINE_DEDUP,
    }
