"""DuckDB statements that say directly what some of the queries return."""

DECONTAMINATION = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
),
b AS (
    SELECT DISTINCT item_id, w, least(10, len(w)) AS n
    FROM (SELECT item_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
    WHERE len(w) > 0
),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
    FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM b)
),
places AS (
    SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
    FROM (
        SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM b) WHERE len(w) >= n
    )
),
hits AS (SELECT r, i, places.n, item_id FROM places JOIN windows USING (n, g)),
words AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r
),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY r
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
keyed AS (
    SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes,
        sha1(payload) AS hex, max(page_id) OVER (PARTITION BY payload) AS last_id
    FROM p
),
parts AS (
    SELECT page_id, list_transform([0, 1, 2, 3],
        lambda i: CAST('0x' || substr(hex, CAST(1 + 10 * i AS BIGINT), 10) AS BIGINT)) AS v
    FROM keyed
),
digests AS (
    SELECT page_id, list_aggregate(flatten(list_transform(v, lambda x: list_transform(
        [35, 30, 25, 20, 15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)
    ))), 'string_agg', '') AS payload_digest
    FROM parts
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = last_id THEN NULL ELSE last_id END AS refers_to
FROM keyed JOIN digests USING (page_id)
"""

_CRC = """list_reduce(
        list_prepend(4294967295, list_transform(string_split({}, ''), lambda c: ord(c))),
        lambda x, byte: list_reduce(
            [xor(x, byte), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda y, unused: xor(y >> 1, (y & 1) * 3988292384))
    )"""

PREFIX_TRIE = (
    r"""
WITH t AS (
    SELECT conv_id, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text) - 1 AS pos,
        sha256(coalesce(role, '') || chr(1) || coalesce(text, '')) AS id,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
    FROM conversations WHERE conv_id IS NOT NULL
),
c AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
        xor("""
    + _CRC.format("CAST(conv_id AS VARCHAR)")
    + r""", 4294967295) % 4 AS h
    FROM t GROUP BY conv_id
),
shifted AS (SELECT c.*, least(h, coalesce(b.n, 0)) AS m
    FROM c LEFT JOIN (SELECT conv_id AS base, n FROM c) AS b USING (base)),
seq AS (
    SELECT t.conv_id, pos - h + m AS pos, id, words FROM t JOIN shifted USING (conv_id)
    WHERE pos >= h
    UNION ALL
    SELECT s.conv_id, t.pos, t.id, t.words FROM shifted AS s JOIN t ON t.conv_id = s.base
    WHERE t.pos < s.h
),
path AS (
    SELECT conv_id, coalesce(list(id ORDER BY pos) FILTER (id IS NOT NULL), []) AS ids,
        coalesce(list(words ORDER BY pos) FILTER (id IS NOT NULL), []) AS words
    FROM c LEFT JOIN seq USING (conv_id) GROUP BY conv_id
),
member AS (
    SELECT conv_id, d, array_to_string(ids[1:d], ' ') AS k, d = len(ids) AS ends,
        array_to_string(ids[1:d - 1], ' ') AS up, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS w
    FROM (SELECT *, unnest(generate_series(0, len(ids))) AS d FROM path)
),
node AS (
    SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * any_value(w) AS saving,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
            FILTER (ends), '')) AS ends_sha256
    FROM member GROUP BY d, k
),
child AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
tree AS (SELECT node.*, coalesce(n_children, 0) AS n_children
    FROM node LEFT JOIN child USING (d, k)),
above AS (
    SELECT a AS d, array_to_string(string_split(k, ' ')[1:a], ' ') AS k, saving,
        n_children = 0 AS leaf
    FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM tree)
),
subtree AS (SELECT d, k, sum(saving) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves
    FROM above GROUP BY d, k)
SELECT tree.conv_id, tree.d AS depth, parent.conv_id AS parent_conv_id, tree.n_convs,
    tree.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, tree.ends_sha256
FROM tree JOIN subtree USING (d, k)
LEFT JOIN node AS parent ON parent.d = tree.d - 1 AND parent.k = tree.up
"""
)

FILL_IN_MIDDLE = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
        sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
    FROM documents
),
h AS (
    SELECT *, len(u) AS n, list_transform([0, 1, 2, 3],
        lambda i: CAST('0x' || substr(hex, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT)) AS h
    FROM t
),
cut AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a,
    greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b FROM h),
part AS (
    SELECT doc_id, text, n, array_to_string(u[1:a], '') AS prefix,
        array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                OR contains(text, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
            WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM part
"""

LINE_DEDUP = r"""
WITH t AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
),
line AS (
    SELECT doc_id, r, i, lines[i] AS line,
        translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT *, unnest(generate_series(1, len(lines))) AS i FROM t)
),
shared AS (
    SELECT k, max(doc_id) AS keeper FROM line WHERE length(k) >= 40
    GROUP BY k HAVING count(DISTINCT doc_id) + bool_or(doc_id IS NULL)::INT >= 5
),
marked AS (
    SELECT line.*, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS lost
    FROM line LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""
