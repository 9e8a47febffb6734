"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

# Word measures, host counts and the beta prior, written from the rules' definitions.
_QUALITY_RULES = rf"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents),
triples AS (
  SELECT *, CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
            ELSE [] END AS t,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM words),
starts AS (
  SELECT doc_id, list(pos) AS hit FROM (
    SELECT doc_id, unnest(ats) AS pos FROM (
      SELECT doc_id, t, list(pos) AS ats FROM (
        SELECT doc_id, unnest(t) AS t, generate_subscripts(t, 1) AS pos FROM triples)
      GROUP BY doc_id, t HAVING count(*) > 1))
  GROUP BY doc_id),
covered AS (
  SELECT doc_id, count(DISTINCT pos + step) AS n FROM (SELECT doc_id, unnest(hit) AS pos FROM starts), range(3) r(step)
  GROUP BY doc_id),
measures AS (
  SELECT t.doc_id, host, no_host, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM triples t LEFT JOIN covered c ON t.doc_id = c.doc_id),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measures),
hosts AS (
  SELECT host, no_host, count(*)::DOUBLE AS docs, sum(base_failed::INT)::DOUBLE AS failed FROM judged GROUP BY ALL),
fit AS (
  SELECT least(greatest(avg(failed / docs), 1e-6), 1 - 1e-6) AS m, var_pop(failed / docs) AS v, avg(1 / docs) AS c
  FROM hosts),
prior AS (
  SELECT m, greatest(m * (1 - m) / greatest(v - m * (1 - m) * c, m * (1 - m) / 1e6) - 1, 1e-3) AS weight FROM fit),
shrunk AS (
  SELECT host, no_host, docs + weight AS total, (failed + m * weight) / (docs + weight) AS rate FROM hosts, prior)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (rate > 0.6 + 2 * sqrt(rate * (1 - rate) / (total + 1))) AS kept,
       rate > 0.6 + 2 * sqrt(rate * (1 - rate) / (total + 1)) AS host_rejected
FROM judged JOIN shrunk USING (host, no_host)
"""

_WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM payloads WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to, true AS intact
FROM payloads p LEFT JOIN firsts f ON p.digest = f.digest
"""

# Windows compared as text: 13 words joined by spaces.
_CONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM phrases),
windows AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc_words, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, w.size, item_id FROM windows w JOIN phrases p ON w.size = p.size AND w.phrase = p.phrase),
hit_words AS (
  SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM doc_words d LEFT JOIN hit_words h ON d.doc_id = h.doc_id LEFT JOIN hit_items i ON d.doc_id = i.doc_id
"""


def _levels() -> str:
    """Windows of 50, 100, ... 51,200 words of distinct texts, and the longest repeated length."""
    parts = ["""texts AS (
  SELECT min(doc_id) AS doc_id, any_value(w) AS w FROM doc_words WHERE len(w) >= 50 GROUP BY md5(array_to_string(w, ' '))),
level50 AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts))"""]
    lengths = [50 << k for k in range(11)]
    for n in lengths[1:]:
        parts.append(f"""level{n} AS (
  SELECT a.doc_id, a.i, md5(a.h || b.h) AS h
  FROM level{n // 2} a JOIN level{n // 2} b ON a.doc_id = b.doc_id AND b.i = a.i + {n // 2})""")
    each = " UNION ALL ".join(
        f"""SELECT DISTINCT doc_id, {n} AS n FROM level{n} WHERE h IN (
    SELECT h FROM level{n} GROUP BY h HAVING min(doc_id) < max(doc_id))""" for n in lengths)
    parts.append(f"longest AS (SELECT doc_id, max(n) AS n FROM ({each}) GROUP BY doc_id)")
    return ",\n".join(parts)


# Windows of 50 words, compared by the MD5 of their text.
_SUBSTRING_DEDUP = rf"""
WITH doc_words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc_words WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first, max(doc_id) AS last FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos
  FROM windows JOIN firsts USING (h) WHERE doc_id > first),
numbered AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM doc_words),
kept AS (
  SELECT n.doc_id, string_agg(word, ' ' ORDER BY n.pos) AS text
  FROM numbered n ANTI JOIN gone g ON n.doc_id = g.doc_id AND n.pos = g.pos GROUP BY n.doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
{_levels()}
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(r.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256,
       CASE WHEN len(d.w) < 50 THEN 0 WHEN t.doc_id IS NOT NULL THEN coalesce(l.n, 0) END::BIGINT AS longest_repeat
FROM doc_words d LEFT JOIN removed r ON d.doc_id = r.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
LEFT JOIN texts t ON d.doc_id = t.doc_id LEFT JOIN longest l ON d.doc_id = l.doc_id
"""

# Shingles compared as text, all pairs that share one, and reachability.
_MINHASH = rf"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(4, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM doc_words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON s.a = x.doc_id JOIN sizes y ON s.b = y.doc_id
  WHERE 100 * s.n >= 80 * (x.n + y.n - s.n)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM doc_words UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM doc_words d LEFT JOIN sizes z ON d.doc_id = z.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON d.doc_id = c.a
"""

# Every document against every item, without an index.
_RANKED_SEARCH = r"""
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
totals AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS terms FROM doc_terms WHERE len(w) > 0),
asked AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark)
  GROUP BY ALL),
held AS (
  SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM doc_terms)
  WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
weighed AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, totals GROUP BY t, docs),
parts AS (
  SELECT doc_id, h.t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS part
  FROM held h JOIN weighed ON h.t = weighed.t, totals),
scored AS (
  SELECT item_id, doc_id, sum(times * part)::BIGINT AS score FROM asked JOIN parts ON asked.t = parts.t GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""

# Lines joined again around the sentinels; the restored text is the text.
_FILL_IN_MIDDLE = r"""
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || doc_id) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n,
         list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(h, i, 8))::BIGINT) AS h FROM lines),
cut AS (
  SELECT doc_id, text, n, array_to_string(u[:least(h[1] % (n + 1), h[2] % (n + 1))], '') AS prefix,
         array_to_string(u[least(h[1] % (n + 1), h[2] % (n + 1)) + 1:greatest(h[1] % (n + 1), h[2] % (n + 1))], '') AS middle,
         array_to_string(u[greatest(h[1] % (n + 1), h[2] % (n + 1)) + 1:], '') AS suffix,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100
              THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": _QUALITY_RULES,
    "op3_decontamination": _CONTAMINATION,
    "op4_warc": _WARC,
    "op8_substring_dedup": _SUBSTRING_DEDUP,
    "op9_minhash": _MINHASH,
    "op11_ball_tree": _RANKED_SEARCH,
    "op13_fill_in_middle": _FILL_IN_MIDDLE,
}
