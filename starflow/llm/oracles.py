"""The same answers in SQL, where SQL can express the whole operator."""

ORACLES: dict[str, str] = {}

ORACLES["op1_mix_sources"] = r"""
WITH docs AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY encode(source) NULLS LAST) AS pos
  FROM docs GROUP BY source
), weighed AS (
  SELECT *, CASE (pos - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM totals
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, pos) AS r FROM weighed
), levels AS (
  SELECT r, source_size, weight,
         (1.5 * (SELECT sum(source_size) FROM weighed)
          - 2 * coalesce(sum(source_size) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM ranked
), lvl AS (
  SELECT coalesce((SELECT level FROM levels WHERE 2 * source_size >= level * weight ORDER BY r LIMIT 1), 0.0) AS level
), goals AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, level * weight) AS target
  FROM weighed, lvl
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM goals
), running AS (
  SELECT d.*, p.source_size, p.target, p.epochs,
         floor(p.target)::BIGINT - p.epochs * p.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM running
"""

ORACLES["op8_exact_dedup"] = """
WITH docs AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM docs WINDOW same AS (PARTITION BY text_sha256)
"""

ORACLES["op12_source_divergence"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), tokens AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), terms AS (
  SELECT lang, term, count(*) AS lang_n FROM tokens
  GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), langs AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM terms GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM tokens SEMI JOIN terms USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(l.v, 0) AS v, coalesce(t.total, 0) + coalesce(l.v, 0) AS whole,
         l.lang_total + l.v AS lang_whole
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN langs l USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t USING (lang, source)
), shares AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // g.whole AS p,
         1 + 1000000000::HUGEINT * (t.lang_n + 1) // g.lang_whole AS q
  FROM groups g JOIN terms t USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         (SELECT 0) + coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  WHERE x.term IS NULL OR y.term IS NOT NULL
  GROUP BY ALL
), found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
  FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
