"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from keelson.llm import line_quality as LQ

ORACLE: dict[str, str] = {}

ORACLE["op1_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace(replace(role, '\', '\\'), chr(10), '\n')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
           + 24)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

_SPACES, _WORD = r"[ \t\n\x0B\f\r]+", r"[^ \t\n\x0B\f\r]"


def _line_fails(x: str) -> str:
    words = f"list_filter(regexp_split_to_array({x}, '{_SPACES}'), lambda v: v <> '')"
    parts = f"(len(regexp_split_to_array({x}, ' [|>»·] ')) - 1)"
    quoted = lambda s: s.replace("'", "''")
    return (f"((regexp_matches({x}, '[#*$%&|<>~^=_]|[!?]{{2}}') AND len(list_filter({words}, lambda v: "
            f"regexp_matches(v, '{quoted(LQ._SYMBOL_WORD)}'))) > 0.2 * len({words}))"
            f" OR ({parts} >= 3 AND len({words}) <= 4 * ({parts} + 1) + {parts})"
            f" OR (length({x}) <= 60 AND regexp_matches(lower({x}), '{quoted(LQ._NAV)}'))"
            f" OR regexp_matches(lower({x}), '{quoted(LQ._BOILER)}'))")


_KEPT_LINES = (f"array_to_string(list_filter(string_split(t, chr(10)), lambda x: "
               f"NOT (regexp_matches(x, '{_WORD}') AND {_line_fails('x')})), chr(10))")

LINE_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM DOCUMENTS_INPUT),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '{_SPACES}'), lambda v: v <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
win AS (SELECT r, i, array_to_string(w[i:i+4], chr(10)) AS g FROM (
          SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (SELECT r, count(DISTINCT i + k)::BIGINT AS n FROM (
          SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win), range(5) AS s(k) WHERE c >= 2 GROUP BY r),
base AS (
  SELECT w.r, doc_id, t, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, {_KEPT_LINES} AS clean
  FROM w LEFT JOIN rep ON w.r = rep.r)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND length(t) - length(clean) <= 0.3 * length(t) AS kept
FROM base
"""

ORACLE["op4_line_quality"] = f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM ({LINE_QUALITY.replace("DOCUMENTS_INPUT", "documents")})
"""


ORACLE["op9_backoff_lm_order2"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}'),
             lambda v: v <> '') AS w FROM documents),
p AS (SELECT r, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS h FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
one AS (SELECT w, count(*) AS c FROM p GROUP BY w),
two AS (SELECT h, w, count(*) AS c FROM p WHERE h IS NOT NULL GROUP BY h, w),
s AS (SELECT r, coalesce(two.c >= 2, false) AS seen, p.h,
             CASE WHEN two.c >= 2 THEN ln(two.c / ctx.c) ELSE ln(one.c / (SELECT count(*) FROM p))
                  + CASE WHEN p.h IS NULL THEN 0 ELSE ln(0.4) END END AS x
      FROM p JOIN one ON p.w = one.w LEFT JOIN one AS ctx ON p.h = ctx.w LEFT JOIN two ON p.h = two.h AND p.w = two.w),
t AS (SELECT r, sum(x) AS x, count(*) AS n, count(*) FILTER (WHERE NOT seen AND h IS NOT NULL) AS b FROM s GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, round(coalesce(x, 0), 4) AS log_score, round(x / n, 6) AS mean_log_score,
       coalesce(b, 0)::BIGINT AS n_backoffs
FROM d LEFT JOIN t ON d.r = t.r
"""

ORACLE["op9_backoff_lm_order3"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACES}'),
             lambda v: v <> '') AS w FROM documents),
p AS (SELECT r, i, w[i] AS w, CASE WHEN i > 1 THEN w[i - 1] END AS h, CASE WHEN i > 2 THEN w[i - 2] END AS g
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
one AS (SELECT w, count(*) AS c FROM p GROUP BY w),
two AS (SELECT h, w, count(*) AS c FROM p WHERE h IS NOT NULL GROUP BY h, w),
three AS (SELECT g, h, w, count(*) AS c FROM p WHERE g IS NOT NULL GROUP BY g, h, w),
s AS (SELECT r, least(i, 3) - CASE WHEN three.c >= 2 THEN 3 WHEN two.c >= 2 THEN 2 ELSE 1 END AS b,
             CASE WHEN three.c >= 2 THEN ln(three.c / pair.c) WHEN two.c >= 2 THEN ln(two.c / ctx.c)
                  ELSE ln(one.c / (SELECT count(*) FROM p)) END AS x
      FROM p JOIN one ON p.w = one.w LEFT JOIN one AS ctx ON p.h = ctx.w LEFT JOIN two ON p.h = two.h AND p.w = two.w
      LEFT JOIN two AS pair ON p.g = pair.h AND p.h = pair.w
      LEFT JOIN three ON p.g = three.g AND p.h = three.h AND p.w = three.w),
t AS (SELECT r, sum(x + b * ln(0.4)) AS x, count(*) AS n, sum(b) AS b FROM s GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, round(coalesce(x, 0), 4) AS log_score, round(x / n, 6) AS mean_log_score,
       coalesce(b, 0)::BIGINT AS n_backoffs
FROM d LEFT JOIN t ON d.r = t.r
"""


ORACLE["op9_backoff_lm"] = ORACLE["op9_backoff_lm_order3"]

_EDIT = "{{'cost': {x}.cost + {c}, 'audit': '{k}' || {x}.audit, 'out': {out}}}"


def _edit(x: str, cost: str, letter: str, line: str = "") -> str:
    """The best repair from a state, after one edit before it; ``line`` is what the edit writes."""
    return _EDIT.format(x=x, c=cost, k=letter, out=f"list_prepend({line}, {x}.out)" if line else f"{x}.out")


def _best(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _row(state: int) -> str:
    """The least (cost, audit, lines) from a state with a row to come: it is deleted, kept or reroled."""
    to = 3 if state == 2 else 2
    keep = {0: "CASE c WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE c WHEN 'u' THEN v2 END",
            2: "CASE c WHEN 'a' THEN v3 END", 3: "CASE c WHEN 'u' THEN v2 END"}[state]
    none = "{'cost': 1000000000, 'audit': '', 'out': []::VARCHAR[]}"
    stay = lambda e: f"CASE WHEN NOT gone AND ({keep if 'keep' in e else 'v0'}) IS NOT NULL THEN {e.replace('keep', f'({keep})')} ELSE {none} END"
    return _best(_edit(f"v{state}", "3", "D"), stay(_edit("keep", "cut", "K", "role || ':' || text")),
                 f"CASE WHEN NOT gone THEN {_edit(f'v{to}', '2 + cut', 'R', repr({2: 'user:', 3: 'assistant:'}[to]) + ' || text')} ELSE {none} END")


ORACLE["op11_turn_repair"] = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda r, k:
    CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, i)) AS entry),
fate AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                        lambda ch: ascii(ch)::BIGINT),
                         lambda r, b: xor(r >> 8, entry[(xor(r, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS f
  FROM conversations, crc),
hit AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM fate WHERE f <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, E' \t\n\x0B\f\r') AS whole FROM hit),
d AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS c0,
         CASE WHEN whole = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(whole, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM ranked),
e AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::INT AS cut FROM d),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (c0 || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM e GROUP BY conv_id),
s AS (
  SELECT conv_id, n + 1 AS i, {{'cost': 0, 'audit': '', 'out': []::VARCHAR[]}} AS v0,
         {{'cost': 4, 'audit': 'II', 'out': ['user:', 'assistant:']}} AS v1,
         {{'cost': 2, 'audit': 'I', 'out': ['assistant:']}} AS v2, {{'cost': 0, 'audit': '', 'out': []::VARCHAR[]}} AS v3
  FROM facts
  UNION ALL
  SELECT conv_id, i, {_best("b0", _edit("w2", "2", "I", "'user:'"))}, {_best("b1", _edit("w2", "2", "I", "'user:'"))}, w2, w3
  FROM (SELECT conv_id, i, b0, b1, {_best("b2", _edit("b3", "2", "I", "'assistant:'"))} AS w2,
               {_best("b3", _edit("b2", "2", "I", "'user:'"))} AS w3
        FROM (SELECT s.conv_id, e.i, {_row(0)} AS b0, {_row(1)} AS b1, {_row(2)} AS b2, {_row(3)} AS b3
              FROM s JOIN e ON s.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = s.i - 1))),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.cost, 0)::BIGINT AS cost,
       coalesce(v0.audit, '') AS audit, sha256(coalesce(array_to_string(v0.out, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN facts ON ids.conv_id IS NOT DISTINCT FROM facts.conv_id
LEFT JOIN s ON ids.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = 1
"""


ORACLE["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
         coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM v AS a, v AS b WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own = label AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND own <> label
            AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
