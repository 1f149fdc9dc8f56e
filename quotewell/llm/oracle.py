"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {}

ORACLE["op1_exact_dedup"] = f"""
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

# An unescaped turn reads back unless it holds an escape or the closing mark of its own role.
ORACLE["op3_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
marks AS (
  SELECT *,
    CASE role WHEN 'user' THEN '[/INST]' WHEN 'assistant' THEN '</s>'
              WHEN 'system' THEN '<</SYS>>' ELSE '<|/role|>' END AS closing,
    CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
              ELSE 18 + length(role) + length(regexp_replace(role, '[^\\<\[|]', '', 'g')) END
      AS frame
  FROM turns
),
sized AS (
  SELECT *, contains(text, closing) OR regexp_matches(text, '\\[0123]') AS conflict,
    length(text) AS plain,
    length(regexp_replace(text, '[^\\<\[|]', '', 'g')) AS extra
  FROM marks
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text))
    AS turns_sha256,
  cast(coalesce(sum(plain) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  cast(sum(frame + plain + CASE WHEN conflict THEN extra ELSE 0 END) AS bigint)
    AS formatted_chars,
  cast(max(CASE WHEN conflict THEN 1 ELSE 0 END) AS integer) AS escape_level
FROM sized GROUP BY conv_id
"""

# CRC-32 of a string of digits and minus signs, bit by bit.
_CRC32 = f"""xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''),
              lambda s: ascii(s)::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z:
    xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))))"""

# Each node's subtree is the set of nodes whose smallest member passes through it, from its depth
# on.
ORACLE["op12_prefix_trie"] = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                       coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT c, {_CRC32} % 6 AS h, c - c % 100 AS base FROM (SELECT DISTINCT c FROM turns)
),
rebuilt AS (
  SELECT v.c, 0 AS own, t.pos, t.role, t.text
  FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
  UNION ALL
  SELECT v.c, 1, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h
),
placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS depth,
    sha256(concat(length(role), ':', role, text)) AS turn, length(text) AS chars
  FROM rebuilt
),
paths AS (
  SELECT c, depth, chars, sha256(string_agg(turn, '') OVER (PARTITION BY c ORDER BY depth)) AS k
  FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM convs
),
tagged AS (
  SELECT p.*, lag(k) OVER (PARTITION BY c ORDER BY depth) AS above,
    depth = max(depth) OVER (PARTITION BY c) AS is_end
  FROM paths p
),
nodes AS (
  SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, any_value(above) AS above,
    any_value(chars) AS chars,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
  FROM tagged GROUP BY depth, k
),
kids AS (SELECT depth - 1 AS depth, above AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, k)
),
totals AS (
  SELECT p.depth, p.k, count(*) FILTER (y.n_children = 0) AS n_leaves,
    sum((y.n_convs - 1) * y.chars) AS saved_tokens
  FROM counted y JOIN paths p ON p.c = y.conv_id AND p.depth <= y.depth
  GROUP BY p.depth, p.k
)
SELECT x.conv_id, x.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children,
  t.n_leaves, t.saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM counted x JOIN totals t USING (depth, k)
LEFT JOIN nodes up ON up.depth = x.depth - 1 AND up.k = x.above
"""
