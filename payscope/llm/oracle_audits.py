"""DuckDB SQL of the audits."""

OP11 = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             concat(CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END,
                    CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
                    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END,
                    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
m AS (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS fails_own,
             length(translate(fails, before, '')) < length(fails) AS gone FROM s, c),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fails_own THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN NOT gone AND fails_own THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN gone AND fails_own THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN NOT gone AND fails_own THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN NOT gone AND fails_own THEN toxic ELSE 0 END) AS toxic_lost FROM m GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""

OP13 = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT row) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT lang, source, coalesce(total, 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 1) // (total + v) AS p
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + 1000000000::HUGEINT * (s.n + 1) // (a.total + v) AS q
      FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) s JOIN (SELECT lang, sum(total) AS total FROM g GROUP BY ALL) a USING (lang) JOIN v USING (lang)),
s AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN s ON s.lang = x.lang AND s.source = x.source AND s.item = y.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""
