"""DuckDB oracle SQL for the dialogue / instruction / sampler queries.

Written from the rules with DuckDB's own constructs (unnest + windows +
string_agg), not from the Spark expressions.
"""

from __future__ import annotations

import re

from corpusloom import constants as K
from corpusloom.operators.permute import place_sql
from corpusloom.plans.sqlfrag import WORD_RE, bytes_ids, ids_str

#: code points that Python's str.strip() removes
WHITE = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = " || ".join(f"chr({c})" for c in WHITE)
SPECIALS = ["<s>", "</s>"] + K.ADDED_SPECIALS


def lit(s: str | None) -> str:
    if s is None:
        return "NULL"
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def ntok(x: str) -> str:
    """Token count of text with atomic specials (no BOS)."""
    n = f"octet_length(encode({x}))"
    parts = [n]
    for s in SPECIALS:
        w = len(s)
        parts.append(f"((octet_length(encode({x})) - octet_length(encode(replace({x}, {lit(s)}, '')))) // {w}) * {w - 1}")
    return "(" + " - ".join(parts) + ")"


def _re_escape(s: str) -> str:
    out = ""
    for ch in s:
        out += "\\" + ch if ch in "\\^$.|?*+()[]{}" else ch
    return out


PIECE_RE = "|".join(_re_escape(s) for s in SPECIALS) + "|[^<\\[]+|[<\\[]"


def tok_specials(x: str) -> str:
    cases = " ".join(f"WHEN {lit(s)} THEN [{K.SPECIAL_IDS[s]}]" for s in SPECIALS)
    return (f"flatten(list_transform(regexp_extract_all({x}, {lit(PIECE_RE)}), "
            f"lambda p: CASE p {cases} ELSE {bytes_ids('p')} END))")


RECORDS = f"""sys AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
nm AS (SELECT conv_id, CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS frm, text,
              CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS pos
       FROM conversations WHERE role <> 'system'),
fh AS (SELECT conv_id, min(pos) AS fpos FROM nm WHERE frm = 'human' GROUP BY conv_id),
raw_msgs AS (
  SELECT nm.conv_id, nm.pos, nm.frm,
         CASE WHEN nm.conv_id % 3 = 0 AND nm.pos = fh.fpos THEN nm.text || chr(10) || '<image>' ELSE nm.text END AS value,
         nm.conv_id % 3 = 0 AS has_img
  FROM nm LEFT JOIN fh ON nm.conv_id = fh.conv_id),
p5 AS (
  SELECT conv_id, pos, frm, has_img,
         CASE WHEN has_img AND contains(value, '<image>')
              THEN {strip("'<image>' || chr(10) || " + strip("replace(value, '<image>', '')"))} ELSE value END AS value
  FROM raw_msgs),
lead_drop AS (SELECT conv_id, max(CASE WHEN pos = 0 AND frm <> 'human' THEN 1 ELSE 0 END) AS d FROM p5 GROUP BY conv_id),
clean AS (SELECT p5.conv_id, p5.pos - ld.d AS pos, p5.frm, p5.value, p5.has_img
          FROM p5 JOIN lead_drop ld ON p5.conv_id = ld.conv_id WHERE p5.pos >= ld.d)"""


def render_parts(name: str, shift: int = 0) -> tuple[str, str]:
    """(head, piece) SQL of template ``name`` over message ``m`` and system row ``s``."""
    system, roles, _, _, style, sep, sep2, _ = K.TEMPLATE_OBJECTS[K.TEMPLATE_NAMES[name]]
    if sep2 is None and style in ("TWO", "PLAIN"):
        sep2 = sep
    sys_ = f"coalesce(s.system, {lit(system)})"
    role = f"CASE WHEN m.frm = 'human' THEN {lit(roles[0])} ELSE {lit(roles[1])} END"
    i = f"(m.pos + {shift})"
    seps = f"CASE WHEN {i} % 2 = 0 THEN {lit(sep)} ELSE {lit(sep2)} END"
    ne = "(m.value IS NOT NULL AND m.value <> '')"
    if style == "SINGLE":
        head, piece = f"{sys_} || {lit(sep)}", f"CASE WHEN {ne} THEN {role} || ': ' || m.value || {lit(sep)} ELSE {role} || ':' END"
    elif style == "TWO":
        head, piece = f"{sys_} || {lit(sep)}", f"CASE WHEN {ne} THEN {role} || ': ' || m.value || {seps} ELSE {role} || ':' END"
    elif style == "MPT":
        head, piece = f"{sys_} || {lit(sep)}", f"CASE WHEN {ne} THEN {role} || m.value || {lit(sep)} ELSE {role} END"
    elif style == "PLAIN":
        head, piece = sys_, f"CASE WHEN {ne} THEN m.value || {seps} ELSE '' END"
    elif style == "LLAMA_2":
        wrap = (f"CASE WHEN length({sys_}) > 0 THEN '<<SYS>>' || chr(10) || {sys_} || chr(10) || '<</SYS>>' || chr(10) "
                f"|| chr(10) ELSE {sys_} END")
        body = (f"CASE WHEN {i} % 2 = 0 THEN {lit(sep + '[INST] ')} || m.value || ' [/INST]' "
                f"ELSE ' ' || m.value || {lit(' ' + sep2)} END")
        head, piece = "''", f"CASE WHEN {ne} THEN (CASE WHEN {i} = 0 THEN {wrap} ELSE '' END) || {body} ELSE '' END"
    elif style == "LLAMA_3":
        wrap = (f"CASE WHEN length({sys_}) > 0 THEN '<|begin_of_text|><|start_header_id|>system<|end_header_id|>' || "
                f"{sys_} || '<|eot_id|>' ELSE {sys_} END")
        body = (f"CASE WHEN {i} % 2 = 0 THEN '<|start_header_id|>user<|end_header_id|>' || m.value || '<|eot_id|>' "
                f"ELSE ' <|start_header_id|>assistant<|end_header_id|>' || m.value || {lit(' ' + sep2)} END")
        head, piece = "''", f"CASE WHEN {ne} THEN (CASE WHEN {i} = 0 THEN {wrap} ELSE '' END) || {body} ELSE '' END"
    else:
        raise ValueError(style)
    return head, piece


def render_sql(name: str, src: str = "clean", shift: int = 0, out: str = "prompt") -> str:
    """SELECT conv_id, has_img, <prompt> FROM src grouped by conversation (template ``name``)."""
    head, piece = render_parts(name, shift)
    return (f"SELECT m.conv_id, bool_or(m.has_img) AS has_img, {head} || string_agg({piece}, '' ORDER BY m.pos) AS {out} "
            f"FROM {src} m LEFT JOIN sys s ON m.conv_id = s.conv_id GROUP BY m.conv_id, s.system")


def pieces_sql(name: str, src: str = "clean") -> str:
    """One row per message piece, plus the head at pos -1 for every conversation."""
    head, piece = render_parts(name)
    return (f"SELECT m.conv_id, CAST(m.pos AS BIGINT) AS pos, {piece} AS piece "
            f"FROM {src} m LEFT JOIN sys s ON m.conv_id = s.conv_id "
            f"UNION ALL SELECT c.conv_id, CAST(-1 AS BIGINT), {head} "
            f"FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sys s ON c.conv_id = s.conv_id")


def fewshot_sql() -> str:
    system, roles, shots, _, _, sep, _, _ = K.TEMPLATE_OBJECTS["vicuna_v0"]
    prefix = "".join(f"{r}: {v}{sep}" for r, v in shots)
    return (f"SELECT m.conv_id, coalesce(s.system, {lit(system)}) || {lit(sep)} || {lit(prefix)} || "
            f"string_agg(CASE WHEN m.value <> '' THEN (CASE WHEN m.frm = 'human' THEN 'Human' ELSE 'Assistant' END) "
            f"|| ': ' || m.value || {lit(sep)} ELSE (CASE WHEN m.frm = 'human' THEN 'Human' ELSE 'Assistant' END) || ':' END, "
            f"'' ORDER BY m.pos) AS prompt FROM clean m LEFT JOIN sys s ON m.conv_id = s.conv_id GROUP BY m.conv_id, s.system")


MMTAG_MSGS = f"""mm AS (
  SELECT conv_id, pos + CASE WHEN has_img THEN 2 ELSE 0 END AS pos, frm, has_img,
         CASE WHEN has_img AND pos = 0 THEN {strip("replace(value, '<image>', '')")} ELSE value END AS value
  FROM raw_msgs
  UNION ALL SELECT conv_id, 0, 'human', true, '<Image><image></Image>' FROM raw_msgs WHERE has_img AND pos = 0
  UNION ALL SELECT conv_id, 1, 'gpt', true, 'Received.' FROM raw_msgs WHERE has_img AND pos = 0)"""

FAMILY_NAME = {"llama_2": ("llama_2", K.LLAMA_2_INST_SEP, 1), "llama_3": ("llama_3", K.LLAMA_3_INST_SEP, 1),
               "default": ("default", " ASSISTANT: ", 2)}


def mask_ctes(family: str, max_len: int, legacy: bool) -> str:
    name, inst, minus = FAMILY_NAME[family]
    sep2 = K.TEMPLATE_OBJECTS[K.TEMPLATE_NAMES[name]][6]
    if family == "default" and not legacy:
        adj = "CASE WHEN i <> 0 THEN -1 ELSE 0 END"
    elif family == "llama_3" and legacy:
        adj = "CASE WHEN i <> 0 THEN 1 ELSE 0 END"
    else:
        adj = "0"
    first = f"string_split(rou, {lit(inst)})[1] || {lit(inst)}"
    return f"""{RECORDS},
rp AS ({render_sql(name)}),
tk AS (SELECT conv_id, has_img, prompt,
              CASE WHEN has_img THEN list_concat([1], {tok_specials('prompt')})
                   ELSE list_concat([1], {tok_specials('prompt')})[1:{max_len}] END AS ids FROM rp),
rd AS (SELECT conv_id, unnest(generate_series(0, len(rs) - 1)) AS i, unnest(rs) AS rou
       FROM (SELECT conv_id, string_split(prompt, {lit(sep2)}) AS rs FROM tk)),
ri AS (SELECT conv_id, i, (rou <> '' AND len(string_split(rou, {lit(inst)})) = 2) AS ok,
              1 + {ntok('rou')} + {adj} AS rl, 1 + {ntok(first)} - {minus} + {adj} AS il FROM rd),
fb AS (SELECT conv_id, min(CASE WHEN NOT ok THEN i END) AS first_bad FROM ri GROUP BY conv_id),
gr AS (SELECT ri.conv_id, ri.i, ri.rl, ri.il FROM ri JOIN fb ON ri.conv_id = fb.conv_id
       WHERE fb.first_bad IS NULL OR ri.i < fb.first_bad),
cu AS (SELECT conv_id, i, 1 + sum(rl) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              - rl AS cur, rl, il FROM gr),
cl AS (SELECT tk.conv_id, 1 + coalesce(sum(gr.rl), 0) AS cur_len FROM tk LEFT JOIN gr ON tk.conv_id = gr.conv_id
       GROUP BY tk.conv_id),
rj AS (SELECT tk.conv_id, (cl.cur_len < {max_len} AND cl.cur_len <> len(list_filter(tk.ids, lambda x: x <> {K.PAD_ID})))
              AS rejected, len(tk.ids) AS n FROM tk JOIN cl ON tk.conv_id = cl.conv_id),
tt AS (SELECT conv_id, unnest(generate_series(0, len(ids) - 1)) AS j, unnest(ids) AS id FROM tk),
lb AS (SELECT tt.conv_id, tt.j, CASE WHEN NOT rj.rejected AND cu.conv_id IS NOT NULL THEN tt.id ELSE -100 END AS lab
       FROM tt JOIN rj ON tt.conv_id = rj.conv_id
       LEFT JOIN cu ON tt.conv_id = cu.conv_id AND tt.j >= cu.cur + cu.il AND tt.j < cu.cur + cu.rl),
mk AS (SELECT lb.conv_id, CAST(max(rj.n) AS BIGINT) AS n_tokens,
              CAST(count(*) FILTER (WHERE lab <> -100) AS BIGINT) AS n_supervised,
              CASE WHEN bool_or(rj.rejected) THEN 'mismatch' ELSE 'ok' END AS status,
              string_agg(CAST(lab AS VARCHAR), ',' ORDER BY lb.j) AS labels
       FROM lb JOIN rj ON lb.conv_id = rj.conv_id GROUP BY lb.conv_id)"""


PAIRS = """pairs AS (
  SELECT u.conv_id, CAST(u.pos // 2 AS BIGINT) AS pair_no, u.value AS instruction, a.value AS output, s.system AS input
  FROM clean u LEFT JOIN clean a ON a.conv_id = u.conv_id AND a.pos = u.pos + 1
  LEFT JOIN sys s ON s.conv_id = u.conv_id
  WHERE u.pos % 2 = 0)"""

SFT = f"""{PAIRS},
sft AS (SELECT conv_id, pair_no,
               {lit(K.SFT_PROMPT_PREFIX)} || CASE WHEN input IS NOT NULL AND input <> '' THEN instruction || chr(10) || input
                                               ELSE instruction END || {lit(K.SFT_PROMPT_SUFFIX)} AS source,
               output || '</s>' AS target FROM pairs),
lab AS (SELECT conv_id, pair_no, src, tgt,
               list_concat(src, tgt)[1:{K.SFT_MAX_SEQ_LENGTH}] AS ids,
               list_concat(list_transform(src, lambda x: -100), tgt)[1:{K.SFT_MAX_SEQ_LENGTH}] AS labels
        FROM (SELECT conv_id, pair_no, list_concat([1], {tok_specials('source')}) AS src, {tok_specials('target')} AS tgt
              FROM sft WHERE target IS NOT NULL)),
bt AS (SELECT *, CAST((row_number() OVER (ORDER BY conv_id, pair_no) - 1) // 32 AS BIGINT) AS batch_id,
              CAST((row_number() OVER (ORDER BY conv_id, pair_no) - 1) % 32 AS BIGINT) AS pos FROM lab)"""

LENGTHS = f"""lens AS (
  SELECT conv_id, bool_or(has_img) AS has_img, sum(len(regexp_extract_all(value, {WORD_RE}))) AS words
  FROM raw_msgs GROUP BY conv_id),
ln AS (SELECT conv_id, has_img, CAST(words + CASE WHEN has_img THEN 128 ELSE 0 END AS BIGINT) AS length,
              CAST(CASE WHEN has_img THEN words ELSE -words END AS BIGINT) AS modality_length, words = 0 AS zero_length
       FROM lens)"""


def megabatch_sql(m: int) -> str:
    return f"""{RECORDS}, {LENGTHS},
ix AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS idx, count(*) OVER () AS n FROM ln),
pl AS ({place_sql('ix', 'idx', 'n')}),
mb AS (SELECT conv_id, length, CAST(place // {m} AS BIGINT) AS mb FROM pl),
rk AS (SELECT conv_id, mb, CAST(row_number() OVER (PARTITION BY mb ORDER BY length DESC, conv_id) AS BIGINT) AS rank FROM mb)"""


ORACLE = {
    "dialogue_turns": f"WITH {RECORDS} SELECT conv_id, pos, frm AS \"from\", value FROM raw_msgs",
    "dialogue_clean": f"WITH {RECORDS} SELECT conv_id, pos, frm AS \"from\", value FROM clean",
    "dialogue_valid": f"""WITH {RECORDS}
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_msgs,
       bool_and(frm = CASE WHEN pos % 2 = 0 THEN 'human' ELSE 'gpt' END) AS valid FROM clean GROUP BY conv_id""",
    "image_placeholder": f"WITH {RECORDS} SELECT conv_id, pos, frm AS \"from\", value FROM p5",
    "image_prefix": f"""WITH {RECORDS}
SELECT conv_id, CASE WHEN has_img THEN '<image>' || chr(10) || value ELSE value END AS first_message FROM clean WHERE pos = 0""",
    "template_route": f"""WITH {RECORDS},
r3 AS ({render_sql('llama_3')}), r2 AS ({render_sql('llama_2')}), rd AS ({render_sql('default')})
SELECT r3.conv_id,
       CASE r3.conv_id % 3 WHEN 0 THEN {lit('meta-llama/Meta-Llama-3-8B-Instruct')}
            WHEN 1 THEN {lit('meta-llama/Llama-2-7b-chat-hf')} ELSE {lit('lmsys/vicuna-7b-v1.5')} END AS model_id,
       CASE r3.conv_id % 3 WHEN 0 THEN 'llama_3' WHEN 1 THEN 'llama_2' ELSE 'default' END AS family,
       CASE r3.conv_id % 3 WHEN 0 THEN r3.prompt WHEN 1 THEN r2.prompt ELSE rd.prompt END AS prompt
FROM r3 JOIN r2 ON r3.conv_id = r2.conv_id JOIN rd ON r3.conv_id = rd.conv_id""",
    "render_single": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({render_sql('llava_v0')})",
    "render_two": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({render_sql('v1')})",
    "render_mpt": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({render_sql('mpt')})",
    "render_llama2": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({render_sql('llama_2')})",
    "render_llama3": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({render_sql('llama_3')})",
    "render_plain": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({render_sql('plain')})",
    "render_mmtag": f"WITH {RECORDS}, {MMTAG_MSGS} SELECT conv_id, prompt FROM ({render_sql('v1_mmtag', src='mm')})",
    "render_v0_fewshot": f"WITH {RECORDS} SELECT conv_id, prompt FROM ({fewshot_sql()})",
    "conversation_json": f"""WITH {RECORDS}
SELECT m.conv_id, to_json(struct_pack(
  system := coalesce(s.system, {lit(K.TEMPLATE_OBJECTS['vicuna_v1'][0])}),
  roles := ['USER', 'ASSISTANT'],
  messages := list([CASE WHEN m.pos % 2 = 0 THEN 'USER' ELSE 'ASSISTANT' END, m.value] ORDER BY m.pos),
  "offset" := 0, sep := ' ', sep2 := '</s>'))::VARCHAR AS json
FROM clean m LEFT JOIN sys s ON m.conv_id = s.conv_id GROUP BY m.conv_id, s.system""",
    "turn_pairs": f"""WITH {RECORDS}, {PAIRS}
SELECT conv_id, pair_no, instruction AS "user", output AS assistant FROM pairs""",
    "tok_image": f"""WITH {RECORDS}, r AS ({render_sql('llama_2')}),
t AS (SELECT conv_id, list_concat([1], {tok_specials('prompt')}) AS ids FROM r)
SELECT conv_id, CAST(len(ids) AS BIGINT) AS n_tokens, {ids_str('ids')} AS input_ids FROM t""",
    "mask_llama2": f"WITH {mask_ctes('llama_2', 2048, True)} SELECT * FROM mk",
    "mask_llama3": f"WITH {mask_ctes('llama_3', 2048, False)} SELECT * FROM mk",
    "mask_two": f"WITH {mask_ctes('default', 2048, True)} SELECT * FROM mk",
    "instruction_scan": f"WITH {RECORDS}, {PAIRS} SELECT conv_id, pair_no, instruction, input, output FROM pairs",
    "sft_prompt": f"WITH {RECORDS}, {SFT} SELECT conv_id, pair_no, source FROM sft",
    "sft_target": f"WITH {RECORDS}, {SFT} SELECT conv_id, pair_no, target FROM sft WHERE target IS NOT NULL",
    "sft_labels": f"""WITH {RECORDS}, {SFT}
SELECT conv_id, pair_no, CAST(len(ids) AS BIGINT) AS n_tokens,
       CAST(len(list_filter(labels, lambda x: x <> -100)) AS BIGINT) AS supervised_tokens,
       {ids_str('ids')} AS input_ids, {ids_str('labels')} AS labels FROM lab""",
    "collate_pad": f"""WITH {RECORDS}, {SFT},
pd AS (SELECT batch_id, pos, ids, labels, max(len(ids)) OVER (PARTITION BY batch_id) AS mx FROM bt),
pp AS (SELECT batch_id, pos, list_concat(ids, list_transform(range(mx - len(ids)), lambda x: {K.SFT_PAD_ID})) AS ids,
              list_concat(labels, list_transform(range(mx - len(labels)), lambda x: -100)) AS labels FROM pd)
SELECT batch_id, pos, {ids_str('ids')} AS input_ids, {ids_str('labels')} AS labels,
       {ids_str(f'list_transform(ids, lambda x: CASE WHEN x <> {K.SFT_PAD_ID} THEN 1 ELSE 0 END)')} AS attention_mask FROM pp""",
    "collate_fault": f"""WITH {RECORDS}, {SFT},
fr AS (SELECT batch_id, pos, ids, labels,
              (min(len(ids)) OVER w <> max(len(ids)) OVER w) OR (min(len(labels)) OVER w <> max(len(labels)) OVER w) AS ragged,
              first_value(ids) OVER (PARTITION BY batch_id ORDER BY pos) AS ids0,
              first_value(labels) OVER (PARTITION BY batch_id ORDER BY pos) AS labels0
       FROM bt WINDOW w AS (PARTITION BY batch_id))
SELECT batch_id, pos, ragged, {ids_str('CASE WHEN ragged THEN ids0 ELSE ids END')} AS input_ids,
       {ids_str('CASE WHEN ragged THEN labels0 ELSE labels END')} AS labels FROM fr""",
    "sample_len": f"WITH {RECORDS}, {LENGTHS} SELECT conv_id, length FROM ln",
    "modality_len": f"WITH {RECORDS}, {LENGTHS} SELECT conv_id, modality_length, zero_length FROM ln",
    "megabatch": f"WITH {megabatch_sql(8)} SELECT conv_id, mb, rank FROM rk",
    "even_chunks_strided": f"""WITH {megabatch_sql(9)}
SELECT conv_id, mb, CAST((rank - 1) % 2 AS BIGINT) AS chunk, CAST((rank - 1) // 2 AS BIGINT) AS chunk_pos FROM rk""",
}

_REJ = " UNION ALL ".join(
    f"SELECT * FROM (WITH {mask_ctes(f, 2048, lg)} SELECT status, CAST(count(*) AS BIGINT) AS n, '{f}' AS family "
    f"FROM mk GROUP BY status)"
    for f, lg in (("llama_2", True), ("llama_3", False), ("default", True))
)
ORACLE["mask_rejects"] = _REJ
ORACLE["mask_rejects_records"] = _REJ
ORACLE["template_route_pieces"] = f"WITH {RECORDS} " + " UNION ALL ".join(
    f"SELECT conv_id, {lit(model)} AS model_id, '{fam}' AS family, pos, piece FROM ({pieces_sql(name)}) WHERE conv_id % 3 = {k}"
    for k, (model, fam, name) in enumerate([("meta-llama/Meta-Llama-3-8B-Instruct", "llama_3", "llama_3"),
                                             ("meta-llama/Llama-2-7b-chat-hf", "llama_2", "llama_2"),
                                             ("lmsys/vicuna-7b-v1.5", "default", "default")]))

SEGMENTS = """SELECT cu.conv_id, CAST(cu.i AS BIGINT) AS round, CAST(greatest(cu.cur + cu.il, 0) AS BIGINT) AS lo,
       CAST(least(cu.cur + cu.rl, rj.n) AS BIGINT) AS hi
FROM cu JOIN rj ON cu.conv_id = rj.conv_id
WHERE NOT rj.rejected AND least(cu.cur + cu.rl, rj.n) > greatest(cu.cur + cu.il, 0)"""

def greedy_walk_sql(name: str, src: str, parts: list[str], n_chunks: int) -> str:
    """Recursive CTE ``name``: the greedy even split, one megabatch row at a time in rank order.

    ``src`` has (parts..., conv_id, rank, len, sz); megabatches with ``sz``
    divisible by the chunk count only.  State: load and size of each chunk; a
    full chunk counts as infinitely loaded; ties go to the first chunk.
    """
    if n_chunks != 2:
        raise ValueError("the oracle walk is written for two chunks")
    on = " AND ".join(f"g.{c} = w.{c}" for c in parts)
    pc = ", ".join(parts)
    wpc = ", ".join(f"w.{c}" for c in parts)
    eff = ("(CASE WHEN w.n0 = w.sz // 2 THEN 'inf'::DOUBLE ELSE w.l0 END) <= "
           "(CASE WHEN w.n1 = w.sz // 2 THEN 'inf'::DOUBLE ELSE w.l1 END)")
    return f"""{name} AS (
  SELECT DISTINCT {pc}, sz, CAST(0 AS BIGINT) AS rank, CAST(NULL AS BIGINT) AS conv_id, -1 AS chunk, -1 AS chunk_pos,
         0.0::DOUBLE AS l0, 0.0::DOUBLE AS l1, 0 AS n0, 0 AS n1
  FROM {src} WHERE sz % 2 = 0
  UNION ALL
  SELECT {wpc}, w.sz, g.rank, g.conv_id,
         CASE WHEN {eff} THEN 0 ELSE 1 END,
         CASE WHEN {eff} THEN w.n0 ELSE w.n1 END,
         CASE WHEN {eff} THEN w.l0 + g.len ELSE w.l0 END,
         CASE WHEN {eff} THEN w.l1 ELSE w.l1 + g.len END,
         CASE WHEN {eff} THEN w.n0 + 1 ELSE w.n0 END,
         CASE WHEN {eff} THEN w.n1 ELSE w.n1 + 1 END
  FROM {name} w JOIN {src} g ON {on} AND g.rank = w.rank + 1)"""


def chunks_sql(src: str, parts: list[str], n_chunks: int) -> str:
    """SELECT parts..., conv_id, chunk, chunk_pos: greedy for divisible megabatches, strided otherwise."""
    pc = ", ".join(parts)
    return (f"SELECT {pc}, conv_id, CAST(chunk AS BIGINT) AS chunk, CAST(chunk_pos AS BIGINT) AS chunk_pos "
            f"FROM walk_{src} WHERE rank > 0 UNION ALL "
            f"SELECT {pc}, conv_id, CAST((rank - 1) % {n_chunks} AS BIGINT), CAST((rank - 1) // {n_chunks} AS BIGINT) "
            f"FROM {src} WHERE sz % {n_chunks} <> 0")


GREEDY = f"""WITH RECURSIVE {megabatch_sql(8)},
gm AS (SELECT rk.conv_id, rk.mb, rk.rank, mb.length AS len, count(*) OVER (PARTITION BY rk.mb) AS sz
       FROM rk JOIN mb ON rk.conv_id = mb.conv_id),
{greedy_walk_sql('walk_gm', 'gm', ['mb'], 2)}
{chunks_sql('gm', ['mb'], 2)}"""

MODALITY = f"""WITH RECURSIVE {RECORDS}, {LENGTHS},
sg AS (SELECT conv_id, modality_length > 0 AS md, abs(modality_length) AS alen, modality_length AS slen FROM ln),
im AS (SELECT *, row_number() OVER (PARTITION BY md ORDER BY conv_id) - 1 AS idx, count(*) OVER (PARTITION BY md) AS n FROM sg),
i1 AS (SELECT *, row_number() OVER (ORDER BY conv_id) - 1 AS idx, count(*) OVER () AS n FROM sg),
nmod AS (SELECT count(DISTINCT md) AS k FROM sg),
-- two modalities: megabatches per modality
pm AS (SELECT conv_id, md, alen AS len, place // 8 AS mb FROM ({place_sql('im', 'idx', 'n')})),
rm AS (SELECT conv_id, md, mb, len, row_number() OVER (PARTITION BY md, mb ORDER BY len DESC, conv_id) AS rank,
              count(*) OVER (PARTITION BY md, mb) AS sz FROM pm),
{greedy_walk_sql('walk_rm', 'rm', ['md', 'mb'], 2)},
cm AS ({chunks_sql('rm', ['md', 'mb'], 2)}),
tl AS (SELECT md, max(mb) AS last FROM cm GROUP BY md),
bd AS (SELECT cm.* FROM cm JOIN tl ON cm.md = tl.md WHERE cm.mb <> tl.last),
bi AS (SELECT md, mb, row_number() OVER (ORDER BY md, mb) - 1 AS idx, count(*) OVER () AS n FROM (SELECT DISTINCT md, mb FROM bd)),
bn AS (SELECT md, mb, place AS batch_no FROM ({place_sql('bi', 'idx', 'n', 1)})),
two AS (
  SELECT bd.conv_id, bn.batch_no, row_number() OVER (PARTITION BY bn.batch_no ORDER BY bd.chunk * 8 + bd.chunk_pos) - 1 AS pos
  FROM bd JOIN bn ON bd.md = bn.md AND bd.mb = bn.mb
  UNION ALL
  SELECT cm.conv_id, (SELECT count(*) FROM bn), row_number() OVER (ORDER BY cm.conv_id) - 1
  FROM cm JOIN tl ON cm.md = tl.md WHERE cm.mb = tl.last),
-- one modality: megabatches over the raw signed lengths
p1 AS (SELECT conv_id, slen AS len, place // 8 AS mb FROM ({place_sql('i1', 'idx', 'n')})),
r1 AS (SELECT conv_id, mb, len, row_number() OVER (PARTITION BY mb ORDER BY len DESC, conv_id) AS rank,
              count(*) OVER (PARTITION BY mb) AS sz FROM p1),
{greedy_walk_sql('walk_r1', 'r1', ['mb'], 2)},
c1 AS ({chunks_sql('r1', ['mb'], 2)}),
one AS (SELECT conv_id, mb AS batch_no, row_number() OVER (PARTITION BY mb ORDER BY chunk * 8 + chunk_pos) - 1 AS pos FROM c1)
SELECT conv_id, CAST(batch_no AS BIGINT) AS batch_no, CAST(pos AS BIGINT) AS pos FROM two WHERE (SELECT k FROM nmod) >= 2
UNION ALL
SELECT conv_id, CAST(batch_no AS BIGINT), CAST(pos AS BIGINT) FROM one WHERE (SELECT k FROM nmod) < 2"""

ORACLE.update({
    "even_chunks_greedy": GREEDY,
    "modality_batches": MODALITY,
    "render_llama2_pieces": f"WITH {RECORDS} {pieces_sql('llama_2')}",
    "render_llama3_pieces": f"WITH {RECORDS} {pieces_sql('llama_3')}",
    "tok_image_pieces": f"""WITH {RECORDS}, pc AS ({pieces_sql('llama_2')}),
t AS (SELECT conv_id, pos, CASE WHEN pos = -1 THEN list_concat([1], {tok_specials('piece')})
                                ELSE {tok_specials('piece')} END AS ids FROM pc)
SELECT conv_id, pos, CAST(len(ids) AS BIGINT) AS n_tokens, {ids_str('ids')} AS input_ids FROM t""",
    "render_single_pieces": f"WITH {RECORDS} {pieces_sql('llava_v0')}",
    "render_mmtag_pieces": f"WITH {RECORDS}, {MMTAG_MSGS} {pieces_sql('v1_mmtag', src='mm')}",
    "render_v0_fewshot_pieces": f"""WITH {RECORDS},
fs AS (SELECT conv_id, pos + 2 AS pos, frm, value FROM clean
       UNION ALL SELECT conv_id, 0, 'human', {lit(K.FEWSHOT_V0[0][1])} FROM (SELECT DISTINCT conv_id FROM conversations)
       UNION ALL SELECT conv_id, 1, 'gpt', {lit(K.FEWSHOT_V0[1][1])} FROM (SELECT DISTINCT conv_id FROM conversations))
{pieces_sql('v0', src='fs')}""",
    "render_two_pieces": f"WITH {RECORDS} {pieces_sql('v1')}",
    "render_mpt_pieces": f"WITH {RECORDS} {pieces_sql('mpt')}",
    "render_plain_pieces": f"WITH {RECORDS} {pieces_sql('plain')}",
    "mask_llama2_long": f"WITH {mask_ctes('llama_2', 2048, True)} SELECT conv_id, n_tokens, n_supervised, status FROM mk",
    "mask_llama3_long": f"WITH {mask_ctes('llama_3', 2048, False)} SELECT conv_id, n_tokens, n_supervised, status FROM mk",
    "mask_llama2_segments": f"WITH {mask_ctes('llama_2', 2048, True)} {SEGMENTS}",
    "mask_llama3_segments": f"WITH {mask_ctes('llama_3', 2048, False)} {SEGMENTS}",
    "mask_two_long": f"WITH {mask_ctes('default', 2048, True)} SELECT conv_id, n_tokens, n_supervised, status FROM mk",
    "mask_two_segments": f"WITH {mask_ctes('default', 2048, True)} {SEGMENTS}",
})


def instead(table: str, select: str, sql: str) -> str:
    """``sql`` over another form of ``conversations``: ``select`` as a first step called ``table``."""
    assert sql.startswith("WITH ")
    return f"WITH {table} AS ({select}),\n" + sql[5:].replace("FROM conversations", f"FROM {table}")


WIDE = """SELECT conv_id, turn, role, chr(12288) || replace(text, ' ', chr(160)) || chr(8195) AS text FROM conversations"""
BROKEN = """SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 AND role = 'assistant' THEN 'user' ELSE role END AS role,
  CASE WHEN conv_id % 11 = 0 THEN CASE WHEN role = 'user' THEN '' ELSE text END
       WHEN conv_id % 13 = 0 THEN ' ' || chr(12288) ELSE text END AS text FROM conversations"""
SAID_MORE = """SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT conv_id, -2, 'system', 'zzz ' || text FROM conversations WHERE turn = 0
  UNION ALL SELECT conv_id, -1, 'system', 'aaa ' || text FROM conversations WHERE turn = 0"""

ORACLE.update({
    "image_placeholder_wide": instead("wide", WIDE, ORACLE["image_placeholder"]),
    "sample_len_wide": instead("wide", WIDE, ORACLE["sample_len"]),
    "system_turns": """SELECT c.conv_id, concat_ws(chr(10), z.text, a.text, s.text) AS system FROM
  (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN (SELECT conv_id, 'zzz ' || text AS text FROM conversations WHERE turn = 0) z ON z.conv_id = c.conv_id
  LEFT JOIN (SELECT conv_id, 'aaa ' || text AS text FROM conversations WHERE turn = 0) a ON a.conv_id = c.conv_id
  LEFT JOIN (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations
             WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = c.conv_id""",
    "dialogue_rejects": instead("broken", BROKEN, f"""WITH {RECORDS},
why AS (SELECT conv_id, bool_and(frm = CASE pos % 2 WHEN 0 THEN 'human' ELSE 'gpt' END) AS order_ok,
               bool_or(pos = 0 AND value = '') AS empty_first,
               sum(len(regexp_extract_all(value, {WORD_RE}))) AS words FROM clean GROUP BY conv_id),
every AS (SELECT c.conv_id, order_ok, empty_first, words FROM (SELECT DISTINCT conv_id FROM conversations) c
          LEFT JOIN why ON why.conv_id = c.conv_id)
SELECT conv_id, 'role_order' AS reason FROM every WHERE NOT order_ok
UNION ALL SELECT conv_id, 'empty_first' FROM every WHERE empty_first
UNION ALL SELECT conv_id, 'no_words' FROM every WHERE coalesce(words, 0) = 0"""),
    "turn_pairs_offset": ORACLE["turn_pairs"],
    "sampler_plain": f"""WITH ix AS (
  SELECT conv_id, row_number() OVER (ORDER BY conv_id) - 1 AS idx, count(*) OVER () AS n
  FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT conv_id, CAST(place // 8 AS BIGINT) AS batch_no, CAST(place % 8 AS BIGINT) AS pos FROM ({place_sql('ix', 'idx', 'n')})""",
    "sft_target_literal": f"""WITH {RECORDS}, {PAIRS}
SELECT conv_id, pair_no, CASE WHEN conv_id % 3 = 0 OR output IS NULL THEN 'None' ELSE output END || {lit(K.EOS_TOKEN)} AS target
FROM pairs""",
})
ORACLE["collate_features"] = f"""WITH {RECORDS}, {SFT},
f AS (SELECT batch_id, pos, len(ids) AS label, ids[1:8 + (batch_id % 2) * (pos % 2)] AS head,
             CASE WHEN batch_id % 3 > 0 OR pos > 0 THEN pair_no END AS weight FROM bt),
b AS (SELECT batch_id, count(DISTINCT len(head)) > 1 AS ragged, arg_min(head, pos) AS head1,
             max(CASE WHEN pos = 0 THEN weight END) AS weight1 FROM f GROUP BY batch_id)
SELECT f.batch_id, f.pos, f.label AS labels, {ids_str('CASE WHEN ragged THEN head1 ELSE head END')} AS head,
       CASE WHEN ragged OR weight1 IS NULL THEN weight1 ELSE weight END AS weight, ragged
FROM f JOIN b ON f.batch_id = b.batch_id"""

# the whole prompt is cut, not its pieces; offsets are running lengths of all parts
_SPECIAL_CUT = "|".join(re.escape(x) for x in ["<s>", "</s>", *K.ADDED_SPECIALS])
_BLANK = WORD_RE[3:-3]  # the characters between the brackets
_IDS = "".join(f"WHEN {lit(x)} THEN {i} " for x, i in K.SPECIAL_IDS.items())
ORACLE["mask_llama2_words"] = f"""WITH {RECORDS}, pc AS ({pieces_sql('llama_2')}),
pr AS (SELECT conv_id, coalesce(string_agg(piece, '' ORDER BY pos), '') AS prompt FROM pc GROUP BY conv_id),
pa AS (SELECT conv_id, pos, sum(len(piece)) OVER (PARTITION BY conv_id ORDER BY pos) - len(piece) AS lo, len(piece) AS n FROM pc),
cut AS (SELECT conv_id, unnest(ps) AS part, unnest(generate_series(1, len(ps))) AS i
        FROM (SELECT conv_id, regexp_extract_all(prompt, {lit(_SPECIAL_CUT)} || '|[{_BLANK}]+|[^<{_BLANK}]+|<') AS ps FROM pr)),
of AS (SELECT *, sum(len(part)) OVER w - len(part) AS start, NOT regexp_matches(part, '^[{_BLANK}]') AS tok FROM cut
       WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
nb AS (SELECT *, sum(tok::INT) OVER (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS tok_no FROM of),
wc AS (SELECT piece, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS piece FROM conversations)
       WHERE piece NOT IN ('<unk>', '<s>', '</s>') GROUP BY piece),
vo AS (SELECT row_number() OVER (ORDER BY cnt DESC, piece) + 2 AS id, piece FROM wc),
tk AS (SELECT nb.conv_id, tok_no, start, start + len(part) AS stop,
              CASE part {_IDS} ELSE coalesce(vo.id, 0) END AS id,
              EXISTS (SELECT 1 FROM pa WHERE pa.conv_id = nb.conv_id AND pa.pos >= 0 AND pa.pos % 2 = 1
                      AND nb.start >= pa.lo AND nb.start < pa.lo + pa.n) AS sup
       FROM nb LEFT JOIN vo ON vo.piece = part
       WHERE tok AND (nb.conv_id % 3 = 0 OR tok_no < 2048))
SELECT conv_id, tok_no::BIGINT AS tok_no, start::BIGINT AS start, stop::BIGINT AS stop, id::INT AS id,
       (CASE WHEN sup THEN id ELSE -100 END)::INT AS label FROM tk
UNION ALL SELECT DISTINCT conv_id, 0, 0, 0, 1, -100 FROM conversations"""
