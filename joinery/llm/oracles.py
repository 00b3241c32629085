"""DuckDB SQL for the queries that SQL can express; the others are held against brute
force, round trips or held-out accuracy in the tests."""

ITEM_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _lower(column: str) -> str:
    return ASCII_LOWER.format(f"coalesce({column}, '')")


NEAR_DUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least.y, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(least.y, d.doc_id)) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON least.x = d.doc_id"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower('text')}, {ITEM_WORDS}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lower('text')}, {ITEM_WORDS}) AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0)),
p AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i,
         unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k),
h AS (SELECT p.doc_id, p.i, p.k, bw.item_id FROM p JOIN bw ON p.k = bw.k AND p.s = bw.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

_OPEN = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", "</s>")}
_CASES = [" ".join(f"WHEN '{r}' THEN '{x[i]}'" for r, x in _OPEN.items()) for i in (0, 1)]
_ESCAPED = r"""regexp_replace(regexp_replace(replace(text, '\', '\\'), '\[(/?)(INST|SYS|OUT|ROLE|s)([\]>:])', '[\\\1\2\3', 'g'),
  '<(/?)(INST|SYS|OUT|ROLE|s)([\]>:])', '<\\\1\2\3', 'g')"""

CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, CASE role {_CASES[0]} ELSE '[ROLE:' || hex(role) || '] ' END || {_ESCAPED}
            || CASE role {_CASES[1]} ELSE ' [/ROLE]' END AS formatted FROM t),
c AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learnt,
         string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, ''
                    ORDER BY turn NULLS FIRST, role, text) AS roles,
         sum(length(formatted)) AS formatted_chars
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars, regexp_full_match(roles, 's?(ua)+') AS valid
FROM c"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
n AS (SELECT x, count(*) AS n FROM links GROUP BY x),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.vec_id, coalesce(n.n, 0) AS n_links, least(d.vec_id, coalesce(least.y, d.vec_id)) AS component_id,
       d.vec_id = least(d.vec_id, coalesce(least.y, d.vec_id)) AS kept
FROM embeddings d LEFT JOIN n ON n.x = d.vec_id LEFT JOIN least ON least.x = d.vec_id"""

REPEATS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM p GROUP BY s),
hit AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM p JOIN f ON p.s = f.s WHERE first < doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM hit GROUP BY doc_id),
kept AS (
  SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.j) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM w) a
  ANTI JOIN hit ON hit.doc_id = a.doc_id AND hit.j = a.j GROUP BY a.doc_id)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(n.n_removed, 0) AS n_removed, sha256(coalesce(kept.kept, '')) AS kept_sha256
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_lower('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
g AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k) GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r,
         (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')),
best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
  FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT ranked.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000"""

SEARCH = rf"""
WITH d AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all({_lower('text')}, {ITEM_WORDS}) AS w FROM documents),
q AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all({_lower('text')}, {ITEM_WORDS}) AS w FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
asked AS (SELECT q, term, count(*) AS rep FROM (SELECT q, unnest(w) AS term FROM q) GROUP BY ALL),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM tf, c GROUP BY term),
m AS (SELECT d, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_terms AS m FROM d, c WHERE len(w) > 0),
scored AS (
  SELECT q, d, doc_id, CAST(sum(rep * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN m USING (d) GROUP BY ALL),
best AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best JOIN q USING (q) WHERE rank <= 10"""

ORACLE_SQL = {
    "op2_near_dup": NEAR_DUP,
    "op3_decontaminate": DECONTAMINATE,
    "op5_chat": CHAT,
    "op10_vectors": VECTORS,
    "op11_substring_dedup": REPEATS,
    "op12_collocations": COLLOCATIONS,
    "op13_ranked_search": SEARCH,
}
