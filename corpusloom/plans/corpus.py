"""Pretraining corpus queries: lines, tokens, packing, split, vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.tokens import decode_bytes, ids_to_string
from corpusloom.operators import packing, vocab
from corpusloom.operators.index import nested_index
from corpusloom.operators.tokenize import detokenize_words, tokenize_bytes_arrow, tokenize_words, word_blocks
from corpusloom.plans import sqlfrag as Q
from corpusloom.plans.inputs import bench_lines, doc_lines
from corpusloom.session import checkpoint_root
from corpusloom.sources.files import union_sources
from corpusloom.sources.testdata import table

BLOCK_SIZE = 512
BATCH_ROWS = 1000
MODEL_VOCAB_SIZE = 32000
ORDER = ["doc_id", "line_no"]


def _tok_lines(spark, sf):
    return tokenize_bytes_arrow(doc_lines(spark, sf), "line")


# byte tokenizer with BOS: token count = UTF-8 bytes + 1, no need to build the ids
def _line_tokens():
    return F.octet_length("line") + F.lit(1)


def lines_scan(spark: SparkSession, sf: str) -> DataFrame:
    return doc_lines(spark, sf)


def tok_bytes(spark, sf):
    t = _tok_lines(spark, sf)
    return t.select("doc_id", "line_no", F.size("input_ids").cast("bigint").alias("n_tokens"),
                    ids_to_string("input_ids").alias("input_ids"))


def detok(spark, sf):
    t = _tok_lines(spark, sf)
    return t.select("doc_id", "line_no", decode_bytes(F.col("input_ids")).alias("line"))


def _blocks(spark, sf):
    """Packed blocks; the batch shuffle carries line text, ids are made after it."""
    return packing.pack_blocks(doc_lines(spark, sf), ORDER, BLOCK_SIZE, batch_rows=BATCH_ROWS, dense_inner=True,
                               length=_line_tokens(), encode=lambda d: tokenize_bytes_arrow(d, "line"))


def pack_blocks(spark, sf):
    blocks = _blocks(spark, sf)
    return blocks.select("batch_id", "block_no", F.size("input_ids").cast("bigint").alias("n_tokens"),
                         ids_to_string("input_ids").alias("input_ids"))


def pack_stats(spark, sf):
    return packing.pack_stats(doc_lines(spark, sf), ORDER, BLOCK_SIZE, batch_rows=BATCH_ROWS, dense_inner=True,
                              length=_line_tokens())


def _block_keys(spark, sf):
    """(batch_id, block_no) of every packed block, from the per-batch block counts (no token arrays)."""
    stats = packing.pack_stats(doc_lines(spark, sf), ORDER, BLOCK_SIZE, batch_rows=BATCH_ROWS, dense_inner=True,
                               length=_line_tokens())
    keys = stats.select("batch_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_blocks") - 1)).alias("block_no"))
    return keys.select("batch_id", "block_no", F.concat_ws("-", "batch_id", "block_no").alias("block_key"))


def split_hash(spark, sf):
    return packing.split_by_hash(_block_keys(spark, sf), "block_key").drop("block_key")


def split_exact(spark, sf):
    return packing.split_exact(_block_keys(spark, sf), "block_key").drop("block_key")


def preview(spark, sf):
    """First train block decoded (the reference logs row 0 of the train split)."""
    train = packing.split_by_hash(_block_keys(spark, sf), "block_key").filter(F.col("split") == "train")
    key = train.select("batch_id", "block_no").orderBy("batch_id", "block_no").first()
    batch, block = (key.batch_id, key.block_no) if key else (-1, -1)
    # only the lines of that block's batch are tokenized and packed
    lines = nested_index(doc_lines(spark, sf), *ORDER, "_at").filter(F.floor(F.col("_at") / BATCH_ROWS) == batch).drop("_at")
    blocks = packing.pack_blocks(lines, ORDER, BLOCK_SIZE, batch_rows=BATCH_ROWS, length=_line_tokens(),
                                 encode=lambda d: tokenize_bytes_arrow(d, "line"))
    return blocks.filter(F.col("block_no") == block).select(
        F.lit(batch).cast("bigint").alias("batch_id"), "block_no", decode_bytes(F.col("input_ids")).alias("text"))


def concat_sources(spark, sf):
    d = doc_lines(spark, sf).withColumn("source", F.lit("documents"))
    b = bench_lines(spark, sf).withColumn("source", F.lit("benchmark"))
    return union_sources([d, b]).select("source", "doc_id", "line_no", "line")


def _vocabs(spark, sf, keep_ext=False):
    """(base, extension pieces, merged): the extension's order (count desc, piece asc) is all the merge
    needs, so only its pieces missing from the base are ranked.  ``keep_ext``: the extension's counts are written once,
    for a caller that reads its pieces as well."""
    base = vocab.vocab_from_text(table(spark, sf, "benchmark"), "text")
    ext_counts = vocab.word_counts(table(spark, sf, "documents"), "text")
    if keep_ext:
        checkpoint_root(spark)
        ext_counts = ext_counts.checkpoint(eager=True)
    ext = vocab.specials_frame(spark).select("piece").unionByName(ext_counts.select("piece"))
    return base, ext, vocab.merge_counts(base, ext_counts)


def vocab_merge(spark, sf):
    return _vocabs(spark, sf)[2].select(F.col("id").cast("bigint").alias("id"), "piece", "score")


def vocab_stats(spark, sf):
    return vocab.vocab_stats(*_vocabs(spark, sf, keep_ext=True))


def vocab_specials(spark, sf):
    merged = _vocabs(spark, sf)[2]
    with_pad = vocab.register_specials(merged, vocab.sft_specials(None) + vocab.mm_specials(None))
    size = merged.agg(F.max("id")).first()[0] + 1  # ids are dense: what was added lies behind them
    return with_pad.filter(F.col("id") >= F.lit(size)).select(F.col("id").cast("bigint").alias("id"), "piece")


def vocab_guard(spark, sf):
    return vocab.vocab_guard(_vocabs(spark, sf)[2], MODEL_VOCAB_SIZE)


def _word_blocks(spark, sf):
    return word_blocks(table(spark, sf, "documents").agg(F.sum(F.octet_length("text"))).first()[0])


def tok_words(spark, sf):
    merged = _vocabs(spark, sf)[2]
    toks = tokenize_words(doc_lines(spark, sf), ORDER, "line", merged, n_blocks=_word_blocks(spark, sf))
    return toks.select("doc_id", "line_no", F.size("input_ids").cast("bigint").alias("n_tokens"),
                       ids_to_string("input_ids").alias("input_ids"))


def detok_words(spark, sf):
    """T4 for the word tokenizer: ids back to pieces joined by one space (specials skipped)."""
    merged, blocks = _vocabs(spark, sf)[2], _word_blocks(spark, sf)
    toks = tokenize_words(doc_lines(spark, sf), ORDER, "line", merged, n_blocks=blocks)
    return detokenize_words(toks, ORDER, "input_ids", merged, n_blocks=blocks).select("doc_id", "line_no", "text")


QUERIES = {
    "lines_scan": lines_scan,
    "tok_bytes": tok_bytes,
    "detok": detok,
    "pack_blocks": pack_blocks,
    "pack_stats": pack_stats,
    "split_hash": split_hash,
    "split_exact": split_exact,
    "preview": preview,
    "concat_sources": concat_sources,
    "vocab_merge": vocab_merge,
    "vocab_stats": vocab_stats,
    "vocab_specials": vocab_specials,
    "vocab_guard": vocab_guard,
    "tok_words": tok_words,
    "detok_words": detok_words,
}

_PACK = Q.packing_ctes(BLOCK_SIZE, BATCH_ROWS)
_HASH32 = "('0x' || substr(md5(batch_id::VARCHAR || '-' || block_no::VARCHAR), 1, 8))::BIGINT"

ORACLE = {
    "lines_scan": f"WITH {Q.DOC_LINES} SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM doc_lines",
    "tok_bytes": f"""WITH {Q.DOC_LINES}
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(octet_length(encode(line)) + 1 AS BIGINT) AS n_tokens,
       {Q.ids_str(f"list_concat([1], {Q.bytes_ids('line')})")} AS input_ids FROM doc_lines""",
    "detok": f"WITH {Q.DOC_LINES} SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM doc_lines",
    "pack_blocks": f"""WITH {_PACK},
t AS (SELECT batch_id, keep, start + unnest(generate_series(0, len(ids) - 1)) AS p, unnest(ids) AS id FROM kp)
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(p // {BLOCK_SIZE} AS BIGINT) AS block_no,
       CAST(count(*) AS BIGINT) AS n_tokens, string_agg(CAST(id AS VARCHAR), ',' ORDER BY p) AS input_ids
FROM t WHERE p < keep GROUP BY batch_id, p // {BLOCK_SIZE}""",
    "pack_stats": f"""WITH {_PACK}
SELECT CAST(batch_id AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(max(total) AS BIGINT) AS n_tokens,
       CAST(ceil(max(keep) / {BLOCK_SIZE}) AS BIGINT) AS n_blocks, CAST(max(total) - max(keep) AS BIGINT) AS n_dropped
FROM kp GROUP BY batch_id""",
    "split_hash": f"""WITH {_PACK}
SELECT CAST(batch_id AS BIGINT) AS batch_id, block_no,
       CASE WHEN {_HASH32} % 10000 < 500 THEN 'eval' ELSE 'train' END AS split FROM blocks_meta""",
    "split_exact": f"""WITH {_PACK},
r AS (SELECT batch_id, block_no, row_number() OVER (ORDER BY {_HASH32}, batch_id::VARCHAR || '-' || block_no::VARCHAR) AS rn,
             count(*) OVER () AS n FROM blocks_meta)
SELECT CAST(batch_id AS BIGINT) AS batch_id, block_no, CASE WHEN rn <= ceil(0.05 * n) THEN 'eval' ELSE 'train' END AS split
FROM r""",
    "preview": f"""WITH {_PACK},
first_blk AS (SELECT batch_id, block_no FROM blocks_meta WHERE {_HASH32} % 10000 >= 500
              ORDER BY batch_id, block_no LIMIT 1),
t AS (SELECT batch_id, keep, start + unnest(generate_series(0, len(ids) - 1)) AS p, unnest(ids) AS id FROM kp)
SELECT CAST(t.batch_id AS BIGINT) AS batch_id, CAST(t.p // {BLOCK_SIZE} AS BIGINT) AS block_no,
       decode(unhex(string_agg(CASE WHEN id >= 3 AND id < 259 THEN lpad(to_hex(id - 3), 2, '0') ELSE '' END, '' ORDER BY p))) AS text
FROM t JOIN first_blk f ON t.batch_id = f.batch_id AND t.p // {BLOCK_SIZE} = f.block_no
WHERE t.p < t.keep GROUP BY t.batch_id, t.p // {BLOCK_SIZE}""",
    "concat_sources": f"""WITH {Q.DOC_LINES}, {Q.BENCH_LINES}
SELECT 'documents' AS source, doc_id, CAST(line_no AS BIGINT) AS line_no, line FROM doc_lines
UNION ALL SELECT 'benchmark', item_id, CAST(line_no AS BIGINT), line FROM bench_lines""",
    "vocab_merge": f"WITH {Q.vocab_ctes()} SELECT CAST(id AS BIGINT) AS id, piece, score FROM merged_v",
    "vocab_stats": f"""WITH {Q.vocab_ctes()}
SELECT 'base' AS vocab, CAST(count(*) AS BIGINT) AS size, CAST(count(DISTINCT piece) AS BIGINT) AS n_distinct,
       CAST(sum(CASE WHEN piece IN ('<unk>', '<s>', '</s>') THEN 1 ELSE 0 END) AS BIGINT) AS n_specials FROM base_v
UNION ALL SELECT 'ext', count(*), count(DISTINCT piece),
                 CAST(sum(CASE WHEN piece IN ('<unk>', '<s>', '</s>') THEN 1 ELSE 0 END) AS BIGINT) FROM ext_v
UNION ALL SELECT 'merged', count(*), count(DISTINCT piece),
                 CAST(sum(CASE WHEN piece IN ('<unk>', '<s>', '</s>') THEN 1 ELSE 0 END) AS BIGINT) FROM merged_v""",
    "vocab_specials": f"""WITH {Q.vocab_ctes()},
want AS (SELECT * FROM (VALUES (0, '[PAD]'), (1, '<image>'), (2, '<pad>')) w(ord, piece)
         WHERE piece NOT IN (SELECT piece FROM merged_v))
SELECT CAST((SELECT count(*) FROM merged_v) + row_number() OVER (ORDER BY ord) - 1 AS BIGINT) AS id, piece FROM want""",
    "vocab_guard": f"""WITH {Q.vocab_ctes()}
SELECT CAST(count(*) AS BIGINT) AS tokenizer_size, CAST({MODEL_VOCAB_SIZE} AS BIGINT) AS model_vocab_size,
       count(*) >= {MODEL_VOCAB_SIZE} AS ok, CAST(greatest(count(*) - {MODEL_VOCAB_SIZE}, 0) AS BIGINT) AS rows_to_add
FROM merged_v""",
    "tok_words": f"""WITH {Q.DOC_LINES}, {Q.vocab_ctes()},
w AS (SELECT doc_id, line_no, unnest(generate_series(1, len(ws))) AS pos, unnest(ws) AS piece
      FROM (SELECT doc_id, line_no, regexp_extract_all(line, {Q.WORD_RE}) AS ws FROM doc_lines)),
j AS (SELECT w.doc_id, w.line_no, w.pos, coalesce(m.id, 0) AS id FROM w LEFT JOIN merged_v m ON w.piece = m.piece),
g AS (SELECT doc_id, line_no, count(*) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS s FROM j GROUP BY 1, 2)
SELECT l.doc_id, CAST(l.line_no AS BIGINT) AS line_no, CAST(1 + coalesce(g.n, 0) AS BIGINT) AS n_tokens,
       '1' || coalesce(',' || g.s, '') AS input_ids
FROM doc_lines l LEFT JOIN g ON l.doc_id = g.doc_id AND l.line_no = g.line_no""",
}

ORACLE["detok_words"] = f"""WITH {Q.DOC_LINES}
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, array_to_string(regexp_extract_all(line, {Q.WORD_RE}), ' ') AS text
FROM doc_lines"""
