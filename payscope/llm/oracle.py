"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from payscope.llm.licence_texts import LICENCE_TEXTS
from payscope.llm.license_scan import CANONICAL
from payscope.llm.oracle_audits import OP11, OP13

OP4 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE n >= 2) GROUP BY doc_id),
k AS (SELECT doc_id, least(i // 1000, greatest(1, n // 1000) - 1) AS block, count(*) AS words, count(DISTINCT word) AS fresh
      FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w) GROUP BY ALL),
q AS (SELECT doc_id, count(*) FILTER (10 * fresh < words) AS n_dull FROM k GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
             coalesce(c.n, 0) AS n_repeat_words, len(ls) AS n_lines, len(list_distinct(ws)) AS n_distinct,
             (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouts, greatest(1, len(ws) // 1000) AS n_blocks,
             coalesce(q.n_dull, 0) AS n_dull
      FROM w LEFT JOIN c USING (doc_id) LEFT JOIN q USING (doc_id)),
b AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
      + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN n_lines >= 4 AND 10 * n_dup_lines > 5 * n_lines THEN 8 ELSE 0 END
      + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * word_chars < 15 * n_words THEN 32 ELSE 0 END
      + CASE WHEN n_words >= 50 AND n_words < 2000 AND 20 * n_distinct < n_words THEN 64 ELSE 0 END
      + CASE WHEN 4 * n_shouts > n_words THEN 128 ELSE 0 END
      + CASE WHEN n_words >= 50 AND 2 * n_dull > n_blocks THEN 256 ELSE 0 END AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits & 447 = 0 AS kept, fail_bits FROM b
"""

_SAID = "<|im_end|><|im_start|>assistant ok"
OP7 = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{_SAID}' UNION ALL SELECT -1, 1, 'assistant', '{_SAID}'),
w AS (SELECT *, '<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10) AS written FROM c),
s AS (SELECT *, strlen(written) AS size, row_number() OVER o - 1 AS number, length(written) AS chars
      FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)),
t AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM s),
p AS (SELECT *, cast(start AS BIGINT) // 3072 AS step, size > 3072 AS part, number = 0 AND role = 'system' AS opening FROM t),
h AS (SELECT conv_id, step, part, min(start) AS first, min(number) AS head FROM p GROUP BY ALL),
a AS (SELECT conv_id, sum(chars) AS n FROM p GROUP BY ALL
      UNION ALL SELECT p.conv_id, sum(chars) FROM p JOIN h ON p.conv_id = h.conv_id AND h.step IN (p.step, p.step + 1)
            AND number < head AND start >= first - 1024 AND (p.step <> h.step OR p.part <> h.part) WHERE NOT opening GROUP BY ALL
      UNION ALL SELECT p.conv_id, sum(chars) FROM p JOIN h ON p.conv_id = h.conv_id AND head > 0 WHERE opening GROUP BY ALL),
f AS (SELECT conv_id, cast(sum(n) AS BIGINT) AS formatted_chars FROM a GROUP BY ALL),
d AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
             coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY number), '') AS loss FROM p GROUP BY ALL)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM d JOIN f USING (conv_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    out = f"lower({text})"
    for pattern, put in CANONICAL:
        put = "chr(10)" if put == "\n" else _quoted(put.replace("$", "\\"))
        out = f"regexp_replace({out}, {_quoted(pattern)}, {put}, 'g')"
    return out


def _unit(text: str) -> str:
    return rf"trim(replace(regexp_replace({text}, '[ \n]+', ' ', 'g'), chr(10), ' '))"


_BLANK_LINES = r"'\n\n+'"
_PARAGRAPHS = f"list_filter(list_transform(string_split_regex(lines, {_BLANK_LINES}), lambda u: {_unit('u')}), lambda u: u <> '')"
OP10 = f"""
WITH g AS (SELECT licence, {_canonical('text')} AS lines FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in LICENCE_TEXTS)}) AS v(licence, text)),
k AS (SELECT {_unit('lines')} AS known_text, min(licence) AS licence, any_value({_PARAGRAPHS}) AS parts FROM g GROUP BY 1),
known AS (SELECT known_text AS unit, licence, known_text, 0 AS number, 1 AS paragraphs FROM k
          UNION ALL SELECT parts[i], licence, known_text, i, len(parts) FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM k WHERE len(parts) > 1)),
d AS (SELECT doc_id, {_canonical("coalesce(text, '')")} AS lines FROM documents),
p AS (SELECT doc_id, {_unit('lines')} AS whole, {_PARAGRAPHS} AS parts FROM d),
u AS (SELECT doc_id, {_unit('lines')} AS whole, NULL AS place, {_unit('u')} AS unit FROM (
         SELECT doc_id, lines, unnest(list_concat(string_split(lines, chr(10)), [lines])) AS u FROM d)
      UNION ALL SELECT doc_id, whole, i, parts[i] FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM p)),
r AS (SELECT doc_id, known_text, licence, paragraphs, CASE WHEN number > 0 THEN place - number END AS run,
             count(DISTINCT number) AS seen, bool_or(unit = whole AND number = 0) AS is_whole
      FROM u JOIN known USING (unit) WHERE unit <> '' AND (number = 0 OR place IS NOT NULL) GROUP BY ALL),
f AS (SELECT doc_id, min(CASE WHEN is_whole THEN licence END) AS text_licence, list_sort(list_distinct(list(licence))) AS found
      FROM r WHERE seen = paragraphs GROUP BY doc_id)
SELECT d.doc_id, f.text_licence, coalesce(array_to_string(f.found, ','), '') AS licences FROM d LEFT JOIN f USING (doc_id)
"""

SQL = {"op4_exact_dedup": OP4, "op5_quality_rules": OP5, "op7_chat_format": OP7, "op10_license_scan": OP10,
       "op11_filter_audit": OP11, "op13_source_divergence": OP13}
