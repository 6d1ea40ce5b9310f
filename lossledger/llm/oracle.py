"""DuckDB SQL for the registered queries that SQL can express, written without the operators' code."""

OP3 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), numbered AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM rows
), sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '<|', ''))) // 2 AS text_size,
    length(role) + (length(role) - length(replace(role, '\', ''))) + (length(role) - length(replace(role, chr(10), '')))
      + (length(role) - length(replace(role, '<|', ''))) // 2 AS role_size,
    before IS NOT NULL AND before = role AS merged
  FROM numbered
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(CASE WHEN merged THEN 11 + text_size ELSE 12 + role_size + 1 + text_size + 11 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP9 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
FROM d WINDOW g AS (PARTITION BY text)
"""

# Earliest deadline first, slot by slot, over one period of 1000; state: the next block of each source.
OP10 = """
WITH RECURSIVE weights AS (
  SELECT 'src0' AS mix_source, 230 AS parts, 1 AS place
  UNION ALL SELECT 'src' || i, 40, i + 1 FROM range(1, 20) t(i)
  UNION ALL SELECT '*', 10, 21
), w AS (SELECT list(parts ORDER BY place) AS parts FROM weights),
slots AS (
  SELECT -1 AS slot, list_transform(parts, lambda p: 0) AS next, 0 AS chosen FROM w
  UNION ALL
  SELECT slot + 1, list_transform(range(1, 22), lambda i: next[i] + CASE WHEN i = best.i THEN 1 ELSE 0 END), best.i
  FROM (
    SELECT slot, next, list_min(list_transform(list_filter(
      list_transform(range(1, 22), lambda i: {
        'late': next[i] >= w.parts[i] OR next[i] * 1000 // w.parts[i] > slot + 1,
        'deadline': ((next[i] + 1) * 1000 + w.parts[i] - 1) // w.parts[i], 'i': i}),
      lambda x: NOT x.late), lambda x: {'deadline': x.deadline, 'i': x.i})) AS best
    FROM slots, w WHERE slot < 999
  )
), schedule AS (
  SELECT mix_source, parts, slot, row_number() OVER (PARTITION BY mix_source ORDER BY slot) - 1 AS in_period
  FROM slots JOIN weights ON place = chosen WHERE slot >= 0
), d AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars, text,
    CASE WHEN source IN (SELECT mix_source FROM weights) AND source <> '*' THEN source ELSE '*' END AS mix_source
  FROM documents
), laid AS (
  SELECT *, coalesce(sum(chars) OVER (PARTITION BY mix_source ORDER BY doc_id NULLS LAST, text NULLS FIRST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d
)
SELECT doc_id, mix_source, start // 65536 AS mix_block, (start // 65536) * 1000 // parts AS mix_release,
  ((start // 65536 + 1) * 1000 + parts - 1) // parts AS mix_deadline,
  (start // 65536) // parts * 1000 + slot AS mix_slot, start % 65536 AS mix_at
FROM laid JOIN schedule USING (mix_source) WHERE in_period = (start // 65536) % parts
"""

def _vector_codes(rounds: int = 6) -> str:
    """Every part against every entry of its codebook, round after round."""
    steps = [
        """
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
), kept AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id, v) AS r, len(v) // 8 AS width FROM whole
), parts AS MATERIALIZED (
  SELECT r, p, v[p * width + 1:(p + 1) * width] AS x FROM kept, range(8) t(p)
), book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 16)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT r, p, x, min(pair) AS best FROM (
    SELECT a.r, a.p, a.x, [list_sum(list_transform(range(1, len(a.x) + 1), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i])))::BIGINT, b.e] AS pair
    FROM parts a JOIN book{k} b ON a.p = b.p) GROUP BY ALL
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS x FROM (
      SELECT p, best[2] AS e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m
      FROM near{k}, range(1, (SELECT max(len(x)) FROM parts) + 1) t(i) GROUP BY ALL) GROUP BY ALL) n ON n.p = b.p AND n.e = b.e
)""")
    return ",\n".join(steps) + f"""
, codes AS (
  SELECT r, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY r
), digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (r), digest
"""


ORACLES = {"op3_chat_formatting": OP3, "op9_exact_dedup": OP9, "op10_mixing": OP10, "op12_vector_codes": _vector_codes()}
