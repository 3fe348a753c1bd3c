"""DuckDB SQL for the registered queries of the operators that SQL can express, written from their rules.

Without SQL: the models (1, 2, 5), the library tokenizers (4, 6), the references of the rules (3) and the mixture's 64-bit
hash (7); their tests compare them with plain Python, the libraries, or held-out labels.
"""

from __future__ import annotations

from .license_scan import TEMPLATES, template_passages
from .multiset_hash import SIGNS, UNIFORM

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ngram_join() -> str:
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w),
t AS (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= 75 * (len(x.g) + len(y.g) - c)),
r AS (SELECT doc_id, doc_id AS k FROM s UNION SELECT l.b, r.k FROM r JOIN links l ON l.a = r.doc_id)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, MIN(k) AS component_id FROM s JOIN r ON r.doc_id = s.doc_id GROUP BY s.doc_id, g"""


def licenses(threshold: float = 0.8, coverage: float = 0.75) -> str:
    def gap(mark: str) -> str:
        """A run of characters outside words in which a passage ends: after a mark and blanks, after a mark and a line end, or
        at a line without words. (Marks are cut where the text was, so RE2 needs no look-around.)"""
        no = "[^A-Za-z0-9]*"
        return f"{no}({mark}([ \\t]+|[^A-Za-z0-9\\n.!?:]*\\n)|\\n[^A-Za-z0-9\\n]*\\n){no}"

    rows = ", ".join(f"('{name}', {total}, {k}, {len(b)}, '{g}')" for name, total, k, b in template_passages(TEMPLATES) for g in sorted(b))
    return f"""
WITH known(license, passages, passage, size, gram) AS (VALUES {rows}),
t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '(?im)^[ \\t]*(dnl|rem)([ \\t\\r\\n])', '\\2', 'g') AS bare FROM documents),
p AS (
  SELECT DISTINCT doc_id, unnest(list_concat(
    string_split(regexp_replace(text, '([.!?])[ \\t]+', '\\1\n', 'g'), '\n'),
    string_split(regexp_replace(bare, '{gap("[.!?]")}', '\x01', 'g'), '\x01'),
    string_split(regexp_replace(bare, '{gap("[.!?:]")}', '\x01', 'g'), '\x01'))) AS p FROM t),
w AS (SELECT doc_id, row_number() OVER () AS place, regexp_extract_all(translate(p, '{UPPER}', '{LOWER}'), '[a-z0-9]+') AS w FROM p),
b AS (
  SELECT doc_id, place, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS b FROM w),
g AS (SELECT doc_id, place, len(b) AS n, unnest(b) AS gram FROM b),
d AS (
  SELECT doc_id, license, passages, passage, place, 2.0 * COUNT(*) / (n + size) AS dice FROM g JOIN known USING (gram)
  GROUP BY doc_id, license, passages, passage, place, n, size),
best AS (SELECT doc_id, license, passages, passage, MAX(dice) AS dice FROM d WHERE dice >= {threshold} GROUP BY ALL),
found AS (
  SELECT doc_id, license, SUM(dice) / passages AS score FROM best GROUP BY doc_id, license, passages HAVING COUNT(*) >= {coverage} * passages)
SELECT i.doc_id, COUNT(license) AS n_licenses, coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses,
       CAST(ROUND(coalesce(MAX(score), 0), 6) AS DOUBLE) AS best_score
FROM (SELECT DISTINCT doc_id FROM documents) i LEFT JOIN found f ON f.doc_id = i.doc_id GROUP BY i.doc_id"""


def multiset() -> str:
    words = ", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS w{k}" for k in range(UNIFORM + 2))
    bit = [f"SUM((w{UNIFORM + 1} >> {j}) & 1)" for j in range(32)] + [f"SUM((w{UNIFORM} >> {j}) & 1)" for j in range(32)]
    lanes = ", ".join([f"CAST(SUM(w{k}) AS HUGEINT) % 4294967296 AS u{k}" for k in range(UNIFORM)]
                      + [f"((CAST(2 * {b} - COUNT(h) AS BIGINT) + 32768) % 65536 + 65536) % 65536 - 32768 AS s{j}" for j, b in enumerate(bit)])
    text = lambda t: " || ".join([f"printf('%08x', CAST({t}.u{k} AS BIGINT))" for k in range(UNIFORM)]
                                 + [f"printf('%04x', ({t}.s{j} + 65536) % 65536)" for j in range(SIGNS)])

    def likeness(a: str, b: str) -> str:
        same = " AND ".join([f"{a}.u{k} = {b}.u{k}" for k in range(UNIFORM)] + [f"{a}.s{j} = {b}.s{j}" for j in range(SIGNS)])
        wrapped = lambda j: f"((({a}.s{j} - {b}.s{j} + 32768) % 65536 + 65536) % 65536 - 32768)"
        apart = " + ".join(f"{wrapped(j)} * {wrapped(j)}" for j in range(SIGNS))
        size = " + ".join(f"{t}.s{j} * {t}.s{j}" for t in (a, b) for j in range(SIGNS))
        return (f"CASE WHEN {same} THEN 1.0 WHEN {size} = 0 THEN 0.0 ELSE "
                f"GREATEST(0.0, 1 - CAST({apart} AS DOUBLE) / CAST({size} AS DOUBLE)) END")

    return f"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id),
         first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS next_text FROM documents),
e AS (
  SELECT doc_id, text, next_text, length(text) AS n_chars,
         left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM n),
x AS (SELECT doc_id, 0 AS which, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e UNION ALL SELECT doc_id, 2, next_text FROM e),
p AS (SELECT doc_id, which, trim(unnest(string_split(regexp_replace(t, '([.!?;|])[ \\t]+', '\\1\n', 'g'), '\n')), ' ') AS p FROM x),
h AS (SELECT doc_id, which, CASE WHEN p <> '' THEN sha256(p) END AS h FROM p),
w AS (SELECT doc_id, which, h, {words.replace("CAST('0x'", "CASE WHEN h IS NULL THEN 0 ELSE CAST('0x'").replace(" AS BIGINT) AS", " AS BIGINT) END AS")} FROM h),
l AS (SELECT doc_id, which, {lanes} FROM w GROUP BY doc_id, which)
SELECT e.doc_id, n_chars, sha256(edited) AS edited_sha256, {text("a")} AS fingerprint, {text("b")} AS edited_fingerprint,
       CAST({likeness("a", "b")} AS DOUBLE) AS near_edited, CAST({likeness("a", "c")} AS DOUBLE) AS near_next
FROM e JOIN l a ON a.doc_id = e.doc_id AND a.which = 0 JOIN l b ON b.doc_id = e.doc_id AND b.which = 1
JOIN l c ON c.doc_id = e.doc_id AND c.which = 2"""


def collocations(least: int = 100, longest: int = 5, top: int = 2000) -> str:
    sizes = ", ".join(f"({k})" for k in range(1, longest + 1))
    return f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM p),
n AS (SELECT lang, SUM(len(w)) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES {sizes}) AS t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, COUNT(*) AS f FROM g GROUP BY ALL HAVING COUNT(*) >= {least}),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n.n AS n, c.cut,
         (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ') JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT f.lang, f.f, string_split(f.phrase, ' ') AS w, f.k, m.k AS m FROM f, (VALUES {sizes}) AS m(k) WHERE m.k > 1 AND m.k < f.k),
longer AS (
  SELECT lang, phrase, MAX(f) AS f FROM (
    SELECT lang, f, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM inner_parts)
  GROUP BY lang, phrase),
kept AS (
  SELECT best.* FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.phrase = best.phrase
  WHERE longer.f IS NULL OR 100 * longer.f < 100 * best.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= {top}"""


def warc(least_bytes: int = 1000) -> str:
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, html, CAST(octet_length(encode(html)) AS BIGINT) AS b, MAX(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, b AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN b >= {least_bytes} AND page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN b >= {least_bytes} AND page_id IS DISTINCT FROM last THEN last END AS refers_to FROM q"""
