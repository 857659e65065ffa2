"""DuckDB SQL for the rows of operators that SQL can express."""

from __future__ import annotations

# The table of CRC-32, made from its polynomial.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(
  list_concat([CAST(b AS BIGINT)], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_steps)"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text; ``crc_table`` is joined."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: CAST(('0x' || p) AS BIGINT))"
    return (f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), "
            f"lambda c, b: xor(c >> 8, crc_steps[1 + (xor(c, b) & 255)])), 4294967295)")


TRIE = f"""WITH {CRC_TABLE},
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 20 AS base, {crc32("CAST(c AS VARCHAR)")} % 4 AS h
  FROM (SELECT DISTINCT c FROM turns), crc_table),
built AS (
  SELECT c, list({{'role': role, 'text': text}} ORDER BY own, place) AS sequence FROM (
    SELECT ids.c, 0 AS own, place, role, text FROM ids JOIN turns ON turns.c = base WHERE place <= h
    UNION ALL SELECT ids.c, 1, place, role, text FROM ids JOIN turns ON turns.c = ids.c WHERE place > h)
  GROUP BY c),
members AS (
  SELECT c, d, sequence[1:d] AS prefix, sequence[1:d - 1] AS above, len(sequence) = d AS ends, sequence[d]['text'] AS last
  FROM (SELECT c, sequence, unnest(range(1, len(sequence) + 1)) AS d FROM built)
  UNION ALL SELECT ids.c, 0, [], NULL, built.c IS NULL, '' FROM ids LEFT JOIN built ON ids.c = built.c),
nodes AS (
  SELECT d, prefix, min(c) AS conv_id, any_value(above) AS above, count(*) AS n_convs,
         (count(*) - 1) * len(regexp_extract_all(any_value(last), '[^\\x20\\x09-\\x0D]+')) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY d, prefix),
children AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
known AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix)),
totals AS (
  SELECT prefix[1:up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT prefix, saved, n_children, unnest(range(0, d + 1)) AS up FROM known) GROUP BY 1)
SELECT known.conv_id, CAST(known.d AS BIGINT) AS depth, parent.conv_id AS parent_conv_id, known.n_convs, known.n_children,
       n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, known.ends_sha256
FROM known JOIN totals USING (prefix) LEFT JOIN nodes parent ON parent.prefix = known.above AND known.d > 0"""


VARIANTS = f"""WITH {CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
         count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY 1, 2),
hashed AS (SELECT run, n, {crc32("doc || ':' || run")} AS h FROM runs, crc_table),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
           ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, CAST(unnest(range(0, length(word))) AS INTEGER) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
         CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)),
chains AS (
  WITH RECURSIVE chain AS (
    SELECT word, word AS root, form AS next FROM forms
    UNION ALL SELECT chain.word, forms.word, forms.form FROM chain JOIN forms ON forms.word = chain.next)
  SELECT word, root FROM chain WHERE next IS NULL)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN chains USING (word)"""
