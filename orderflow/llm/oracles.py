"""SQL results of the operators that SQL can express."""

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

op11_line_dedup = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, i, lines[i] AS line FROM split, unnest(range(1, len(lines) + 1)) AS t(i)),
keyed AS (SELECT *, translate(trim(line, {SPACE}), '{UPPER}', '{LOWER}') AS k FROM numbered),
shared AS (
  SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
),
judged AS (SELECT keyed.*, shared.k IS NOT NULL AND doc_id <> owner AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

op12_ranked_search = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
items AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM benchmark
),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs),
asked AS (SELECT item_id, term, count(*) AS qf FROM (SELECT item_id, unnest(terms) AS term FROM items) GROUP BY ALL),
postings AS (
  SELECT r, doc_id, term, n, count(*) AS tf FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM postings, totals GROUP BY term
),
scores AS (
  SELECT item_id, r, doc_id,
    sum(qf * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY ALL
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

# CRC-32 of the decimal id, bit by bit: 3988292384 is its reversed polynomial.
CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(1, length(c) + 1), lambda i: unicode(substr(c, i, 1))::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

op13_prefix_trie = f"""
WITH turns AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list(struct_pack(id := id, words := words) ORDER BY turn NULLS FIRST, id, words) AS t FROM turns GROUP BY conv_id
),
borrowed AS (SELECT *, CAST({CRC} % 4 AS BIGINT) AS h FROM (SELECT *, CAST(conv_id AS VARCHAR) AS c FROM own)),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.t, [])[1:h], o.t[h + 1:]) AS t
  FROM borrowed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
),
places AS (
  SELECT conv_id, len(t) AS turns, d, array_to_string(list_transform(t[1:d], lambda x: x.id), '') AS k,
    CASE WHEN d > 0 THEN t[d].words ELSE 0 END AS words
  FROM rebuilt, unnest(range(0, len(t) + 1)) AS r(d)
),
nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (turns = d), '')) AS ends_sha256
  FROM places GROUP BY k, d
),
children AS (SELECT left(k, 32 * (d - 1)) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
judged AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
below AS (
  SELECT left(k, 32 * a) AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM judged, unnest(range(0, d + 1)) AS r(a) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM judged n JOIN below b USING (k) LEFT JOIN nodes p ON n.d > 0 AND p.k = left(n.k, 32 * (n.d - 1))
"""

ORACLES = {name: sql for name, sql in globals().items() if name.startswith("op")}
