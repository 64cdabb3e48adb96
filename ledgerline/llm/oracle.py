"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP4 = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, pos, lines[pos] AS line, translate(trim(lines[pos], {_SPACE}), {_LOWER}) AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM split)
), frequent AS (
  SELECT key, max(doc_id) AS keeper FROM line
  WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.doc_id, l.pos, l.line, f.key IS NOT NULL AND l.doc_id <> f.keeper AS gone
  FROM line l LEFT JOIN frequent f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _op9(rounds: int = 8, blocks: int = 10, tolerance: float = 1e-3, fraction: float = 0.5, power: float = 0.5, seed: int = 17) -> str:
    """The raking of ``mixing.mix_sources``, one common table per step.

    After each ``rounds`` rounds the margins are measured; the weights are those of the first block of rounds after
    which they are within the tolerance. No row is kept if none of the unrolled blocks is.
    """
    dimensions = ("source", "lang", "topic")
    steps = []
    for d in dimensions:
        steps.append(
            f"t_{d} AS MATERIALIZED (SELECT {d}, n / sum(n) OVER () * (SELECT {fraction} * sum(tokens) FROM cells) AS target "
            f"FROM (SELECT {d}, pow(sum(tokens), {power}) AS n FROM cells GROUP BY {d}))"
        )
    last = "w0"
    steps.append("w0 AS (SELECT *, tokens::DOUBLE AS w FROM cells)")
    done = []
    for block in range(blocks):
        for i in range(rounds):
            for d in dimensions:
                name = f"w_{block}_{i}_{d}"
                steps.append(
                    f"{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, "
                    f"c.w * t.target / sum(c.w) OVER (PARTITION BY c.{d}) AS w FROM {last} c "
                    f"JOIN t_{d} t ON c.{d} IS NOT DISTINCT FROM t.{d})"
                )
                last = name
        errors = " UNION ALL ".join(
            f"SELECT abs(sum(c.w) / any_value(t.target) - 1) AS e FROM {last} c "
            f"JOIN t_{d} t ON c.{d} IS NOT DISTINCT FROM t.{d} GROUP BY c.{d}"
            for d in dimensions
        )
        done.append(f"SELECT {block} AS block, *, (SELECT max(e) FROM ({errors})) AS error FROM {last}")
    return f"""
WITH docs AS (
  SELECT doc_id, source, lang, len(string_split(coalesce(text, ''), ' ')) AS n_tokens,
         CASE WHEN contains(text, '|') THEN 'table' WHEN contains(text, 'icense') THEN 'legal'
              WHEN contains(text, '@') THEN 'contact' ELSE 'prose' END AS topic
  FROM documents
), cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens) AS tokens FROM docs GROUP BY ALL
), {", ".join(steps)},
raked AS MATERIALIZED ({" UNION ALL ".join(done)}),
final AS (SELECT * FROM raked WHERE block = (SELECT min(block) FROM raked WHERE error <= {tolerance}))
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens,
       round(least(1.0, w / tokens), 6) AS probability, round(greatest(1.0, w / tokens), 6) AS weight
FROM docs d JOIN final c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang
  AND d.topic IS NOT DISTINCT FROM c.topic
WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0
      < least(1.0, w / tokens)
"""


ORACLE_SQL = {"op4_line_dedup": OP4, "op9_mixing": _op9()}


def _op12() -> str:
    """Turns and losses as stated; formatted lengths from the template's marks and the escapes, each of which adds one."""
    controls = r"<\|im_start\|>|<\|im_end\|>|</?s>|\[/?INST\]|<</?SYS>>"
    extra = "len(regexp_extract_all({0}, '" + controls + r"')) + length({0}) - length(replace({0}, '\', ''))"
    return f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), line AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    length('<|im_start|><|im_end|>') + 2 + length(text) + {extra.format("text")}
    + length(role) + {extra.format("role")} + length(role) - length(replace(role, chr(10), '')) AS n
  FROM given
), placed AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS so_far,
    pos = max(pos) OVER (PARTITION BY conv_id) AS is_last
  FROM line
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(so_far) FILTER (WHERE role = 'assistant' OR is_last)::BIGINT AS formatted_chars,
  count(*) FILTER (WHERE role = 'assistant' OR is_last) AS n_examples
FROM placed GROUP BY conv_id
"""


ORACLE_SQL["op12_chat_format"] = _op12()
