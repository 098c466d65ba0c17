"""DuckDB SQL fragments for the oracle queries (independent re-statements).

These are written straight from the rules, token by token where needed, so
they check the Spark plans rather than share code with them.
"""

WORD_RE = (r"'[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'")


def bytes_ids(x: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({x})), '..'), lambda h: ('0x' || h)::INTEGER + 3)"


def ids_str(x: str) -> str:
    return f"array_to_string({x}, ',')"


DOC_LINES = """doc_lines AS (
  SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS line_no, unnest(ls) AS line
  FROM (SELECT doc_id,
               string_split(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n\\z', ''), chr(10)) AS ls
        FROM documents))"""

BENCH_LINES = """bench_lines AS (
  SELECT item_id, unnest(generate_series(0, len(ls) - 1)) AS line_no, unnest(ls) AS line
  FROM (SELECT item_id,
               string_split(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n\\z', ''), chr(10)) AS ls
        FROM benchmark))"""


def packing_ctes(block: int, batch_rows: int) -> str:
    return f"""{DOC_LINES},
tok AS (SELECT doc_id, line_no, list_concat([1], {bytes_ids('line')}) AS ids FROM doc_lines),
ix AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS idx FROM tok),
bt AS (SELECT idx // {batch_rows} AS batch_id, idx, ids,
              sum(len(ids)) OVER (PARTITION BY idx // {batch_rows} ORDER BY idx
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - len(ids) AS start,
              sum(len(ids)) OVER (PARTITION BY idx // {batch_rows}) AS total
       FROM ix),
kp AS (SELECT *, CASE WHEN total >= {block} THEN total // {block} * {block} ELSE total END AS keep FROM bt),
blocks_meta AS (
  SELECT batch_id, CAST(unnest(generate_series(0, CAST(ceil(keep / {block}) AS BIGINT) - 1)) AS BIGINT) AS block_no
  FROM (SELECT DISTINCT batch_id, keep FROM kp))"""


def vocab_ctes() -> str:
    return f"""base_w AS (
  SELECT piece, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS piece FROM benchmark)
  WHERE piece NOT IN ('<unk>', '<s>', '</s>') GROUP BY piece),
base_v AS (
  SELECT 0 AS id, '<unk>' AS piece, 0.0::DOUBLE AS score UNION ALL SELECT 1, '<s>', 0.0 UNION ALL SELECT 2, '</s>', 0.0
  UNION ALL SELECT CAST(row_number() OVER (ORDER BY cnt DESC, piece) + 2 AS INTEGER), piece, cnt::DOUBLE FROM base_w),
ext_w AS (
  SELECT piece, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS piece FROM documents)
  WHERE piece NOT IN ('<unk>', '<s>', '</s>') GROUP BY piece),
ext_v AS (
  SELECT 0 AS id, '<unk>' AS piece, 0.0::DOUBLE AS score UNION ALL SELECT 1, '<s>', 0.0 UNION ALL SELECT 2, '</s>', 0.0
  UNION ALL SELECT CAST(row_number() OVER (ORDER BY cnt DESC, piece) + 2 AS INTEGER), piece, cnt::DOUBLE FROM ext_w),
merged_v AS (
  SELECT id, piece, score FROM base_v
  UNION ALL
  SELECT CAST((SELECT count(*) FROM base_v) + row_number() OVER (ORDER BY e.id) - 1 AS INTEGER), e.piece, 0.0
  FROM ext_v e WHERE e.piece NOT IN (SELECT piece FROM base_v))"""
