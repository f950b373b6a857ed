"""SQL counterparts of the registered queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

PAT = (
    r"<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>"
    r"|\p{L}+|\p{N}+|[ \t\r\n]|[^ \t\r\n\p{L}\p{N}]"
)
ROLE_PAT = (
    r"<\|system\|>|<\|user\|>|<\|assistant\|>|</s>"
    r"|\p{L}+|\p{N}+|[ \t\r\n]|[^ \t\r\n\p{L}\p{N}]"
)
NL = "chr(10)"
HEADER = f"'<|im_start|>assistant' || {NL}"
SYSTEM = "You are a helpful assistant."


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TURNS = f"""turns AS (
  SELECT conv_id AS row_id, turn, role, text AS content,
         CASE WHEN conv_id % 20 = 0 THEN 'validation' ELSE 'train' END AS split,
         max(turn) OVER (PARTITION BY conv_id) AS last_turn,
         '<|im_start|>' || role || {NL} || text || '<|im_end|>' AS tight,
         '<|im_start|>' || role || {NL} || text || '<|im_end|>' || {NL} AS rendered,
         '<|' || role || '|>' || {NL} || text || '</s>' || {NL} AS by_role
  FROM conversations)"""

SIZES = """sizes AS (
  SELECT conv_id AS row_id,
         CASE WHEN conv_id % 20 = 0 THEN 'validation' ELSE 'train' END AS split,
         count(*) AS n_turns
  FROM conversations GROUP BY conv_id)"""


def texts(column: str = "rendered") -> str:
    """Full text and prompt text of every conversation."""
    return f"""texts AS (
  SELECT row_id, split, string_agg({column}, '' ORDER BY turn) AS full_text,
         coalesce(string_agg({column}, '' ORDER BY turn) FILTER (WHERE turn < last_turn), '')
           || {HEADER} AS prompt_text
  FROM turns GROUP BY row_id, split)"""


MARKS = ("<|unk|>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
ROLE_MARKS = ("<|unk|>", "</s>", "<|system|>", "<|user|>", "<|assistant|>")


def vocab(marks: tuple[str, ...] = MARKS, column: str = "rendered", pattern: str = PAT) -> str:
    specials = " UNION ALL ".join(
        f"SELECT '{m}' AS piece, {i} AS id, 0 AS n, true AS is_special" for i, m in enumerate(marks)
    )
    return f"""vocab AS (
  {specials}
  UNION ALL
  SELECT piece, CAST(row_number() OVER (ORDER BY n DESC, piece) + {len(marks) - 1} AS INTEGER), n,
         false
  FROM (SELECT piece, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all({column}, '{pattern}')) AS piece
              FROM turns WHERE split = 'train')
        WHERE piece NOT IN {marks}
        GROUP BY piece ORDER BY n DESC, piece LIMIT 2000))"""


VOCAB = vocab()


def cut(limit: int | None = 1024, pattern: str = PAT) -> str:
    """Pieces of the full text cut to ``limit``, and the capped prompt length."""
    slice_ = f"regexp_extract_all(full_text, '{pattern}')"
    prompt = f"len(regexp_extract_all(prompt_text, '{pattern}'))"
    return f"""cut AS (
  SELECT row_id, split, list_slice({slice_}, 1, {limit}) AS pieces,
         least({prompt}, len({slice_}), {limit}) AS prompt_len
  FROM texts)"""


def ids_of(source: str, key: str) -> str:
    """``ids(key, ids)`` for ``source(key, pieces)``."""
    return f"""places AS (
  SELECT {key}, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos FROM {source}),
ids AS (
  SELECT {key}, list(coalesce(id, 0) ORDER BY pos) AS ids
  FROM places LEFT JOIN vocab USING (piece) GROUP BY {key})"""


ENCODED = """encoded AS (
  SELECT row_id, split, coalesce(ids, []) AS ids, prompt_len FROM cut LEFT JOIN ids USING (row_id))"""


def length_labels(eos: bool) -> str:
    last = "WHEN i = len(ids) AND x = 2 THEN -100 " if eos else ""
    return f"list_transform(ids, lambda x, i: CASE WHEN i <= prompt_len THEN -100 {last}ELSE x END)"


def joined(expression: str) -> str:
    return f"array_to_string({expression}, ' ')"


def labelled(eos: bool = True, column: str = "rendered") -> str:
    """All CTEs up to ``labelled(row_id, split, ids, labels)``."""
    return with_(
        TURNS,
        texts(column),
        VOCAB,
        cut(),
        ids_of("cut", "row_id"),
        ENCODED,
        f"labelled AS (SELECT row_id, split, ids, {length_labels(eos)} AS labels FROM encoded)",
    )


# The marker is three pieces long: turn start, the role, and a newline.
MARKED = """marker AS (
  SELECT (SELECT id FROM vocab WHERE piece = '<|im_start|>') AS a,
         coalesce((SELECT id FROM vocab WHERE piece = 'assistant'), 0) AS b,
         coalesce((SELECT id FROM vocab WHERE piece = chr(10)), 0) AS c),
opened AS (
  SELECT row_id, split, ids,
         coalesce(list_max(list_filter(range(1, len(ids) - 1),
           lambda i: ids[i] = a AND ids[i + 1] = b AND ids[i + 2] = c)) + 2, len(ids)) AS opened
  FROM encoded, marker),
labelled AS (
  SELECT row_id, split, ids,
         list_transform(ids, lambda x, i:
           CASE WHEN i <= opened OR (i = len(ids) AND x = 2) THEN -100 ELSE x END) AS labels
  FROM opened)"""

BY_MARKER = with_(TURNS, texts(), VOCAB, cut(), ids_of("cut", "row_id"), ENCODED, MARKED)

BY_ROLE = with_(
    TURNS,
    texts("by_role"),
    vocab(ROLE_MARKS, "by_role", ROLE_PAT),
    cut(pattern=ROLE_PAT),
    ids_of("cut", "row_id"),
    ENCODED,
    """labelled AS (
  SELECT row_id, split, ids, list_transform(ids, lambda x, i:
    CASE WHEN i <= opened OR (i = len(ids) AND x = 1) THEN -100 ELSE x END) AS labels
  FROM (SELECT *, coalesce(list_max(list_filter(range(1, len(ids) + 1), lambda i: ids[i] = 4)),
                           len(ids)) AS opened FROM encoded))""",
)

ACTIVE = "CAST(len(list_filter(labels, lambda x: x <> -100)) AS BIGINT)"

ROWS = f"""SELECT row_id, split, {joined('ids')} AS input_ids,
       {joined('list_transform(ids, lambda x: 1)')} AS attention_mask,
       {joined('labels')} AS labels
FROM labelled"""

PROMPTS = f"""prompts AS (
  SELECT item_id AS prompt_id, text AS user_text,
         '<|im_start|>system' || {NL} || '{SYSTEM}' || '<|im_end|>' || {NL}
           || '<|im_start|>user' || {NL} || text || '<|im_end|>' || {NL} AS text
  FROM benchmark)"""

PROMPT_IDS = with_(
    TURNS,
    VOCAB,
    PROMPTS,
    f"split_prompts AS (SELECT prompt_id, regexp_extract_all(text, '{PAT}') AS pieces FROM prompts)",
    ids_of("split_prompts", "prompt_id"),
)

# Epochs 0 and 1, seed 17, 4 rows per batch, 2 x 2 batches per step.
PLAN = (
    SIZES
    + """,
epochs AS (SELECT row_id, unnest([0, 1]) AS epoch FROM sizes WHERE split = 'train'),
ordered AS (
  SELECT row_id, CAST(epoch AS BIGINT) AS epoch,
         row_number() OVER (PARTITION BY epoch
           ORDER BY md5('17-' || epoch || '-' || row_id), row_id) - 1 AS idx,
         count(*) OVER (PARTITION BY epoch) AS n_train
  FROM epochs),
plan AS (
  SELECT row_id, epoch, idx, idx // 4 AS batch_id,
         CAST(epoch * ceil(n_train / 16.0) + idx // 16 AS BIGINT) AS step
  FROM ordered)"""
)

LABELLED_PLAN = labelled() + ", " + PLAN


def fitted(side: str) -> dict[str, str]:
    """Each array, padded, as a string."""
    fill = "list_transform(range(0, width - len(ids)), lambda i: {})"
    ids, mask, labels = (fill.format(x) for x in (2, 0, -100))
    values = [
        (ids, "ids", "input_ids"),
        (mask, "list_transform(ids, lambda x: 1)", "attention_mask"),
        (labels, "labels", "labels"),
    ]
    return {
        name: joined(f"list_concat({v}, {f})" if side == "right" else f"list_concat({f}, {v})")
        for f, v, name in values
    }


WIDE = LABELLED_PLAN + """, wide AS (
  SELECT *, CAST(max(len(ids)) OVER (PARTITION BY epoch, batch_id) AS BIGINT) AS width
  FROM plan JOIN labelled USING (row_id))
"""


def padded(side: str) -> str:
    columns = ", ".join(f"{expression} AS {name}" for name, expression in fitted(side).items())
    return WIDE + f"SELECT epoch, batch_id, row_id, width, {columns} FROM wide"


def in_batches() -> str:
    columns = ", ".join(
        f"string_agg(md5({expression}), ' ' ORDER BY idx) AS {name}"
        for name, expression in fitted("right").items()
    )
    return WIDE + f"""SELECT epoch, batch_id, CAST(1 AS BIGINT) AS n_files, max(width) AS width,
       string_agg(CAST(row_id AS VARCHAR), ' ' ORDER BY idx) AS row_id, {columns}
FROM wide GROUP BY epoch, batch_id"""


WHOLE_TEXTS = """whole_texts AS (
  SELECT row_id, split, count(*) AS n_messages, string_agg(rendered, '' ORDER BY turn) AS text
  FROM turns GROUP BY row_id, split)"""

# Rows of files by their position in the split.
POSITIONED = f"""SELECT split, row_number() OVER (PARTITION BY split ORDER BY row_id) - 1 AS idx,
       {joined('ids')} AS input_ids,
       {joined('list_transform(ids, lambda x: 1)')} AS attention_mask,
       {joined('labels')} AS labels
FROM labelled"""

QUARANTINE = """SELECT split, '{broken' AS text, 'not JSON' AS reason FROM sizes WHERE row_id % 4 = 2
UNION ALL
SELECT split, '{"row_id":' || row_id || '}', 'no usable messages' FROM sizes WHERE row_id % 7 = 3
UNION ALL
SELECT split, '{"row_id":' || row_id || ',"messages":[{"role":"user"}]}', 'no usable messages'
FROM sizes WHERE row_id % 7 = 5"""


ENCODED = (
    with_(
        TURNS,
        VOCAB,
        f"docs AS (SELECT doc_id, regexp_extract_all(text, '{PAT}') AS pieces FROM documents)",
        ids_of("docs", "doc_id"),
    )
    + f"""SELECT doc_id, coalesce({joined('ids')}, '') AS input_ids
FROM docs LEFT JOIN ids USING (doc_id)"""
)

ORACLES: dict[str, str] = {
    "jsonl_strict": with_(TURNS, WHOLE_TEXTS)
    + """SELECT split, row_number() OVER (PARTITION BY split ORDER BY row_id) - 1 AS idx,
       n_messages, text FROM whole_texts""",
    "jsonl_tolerant": with_(TURNS, WHOLE_TEXTS)
    + """SELECT 'train' AS split, row_number() OVER (ORDER BY row_id) - 1 AS idx,
       n_messages, text FROM whole_texts""",
    "jsonl_rejects": with_(TURNS, WHOLE_TEXTS)
    + """SELECT ']' || row_id AS text, 'not JSON' AS reason FROM whole_texts
UNION ALL SELECT CAST(row_id AS VARCHAR), 'not an object' FROM whole_texts""",
    "split_cap": with_(SIZES)
    + """SELECT row_id, split, n_turns FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY row_id) AS rn FROM sizes)
WHERE rn <= 20""",
    "split_union": with_(SIZES) + "SELECT row_id, n_turns, split FROM sizes",
    "prompt_files": """SELECT item_id AS prompt_id, CAST(2 AS BIGINT) AS n_messages,
       'system' AS first_role, text AS user_text FROM benchmark""",
    "file_line_counts": with_(SIZES)
    + """SELECT split AS name, true AS found, count(*) AS n_lines FROM sizes GROUP BY split
UNION ALL SELECT 'missing', false, 0""",
    "tokenized_sink": labelled()
    + f"""SELECT row_id, split, md5({joined('ids')}) AS input_ids_md5,
       md5({joined('list_transform(ids, lambda x: 1)')}) AS attention_mask_md5,
       md5({joined('labels')}) AS labels_md5 FROM labelled""",
    "vocab_save_load": with_(TURNS, VOCAB) + "SELECT piece, id, n, is_special FROM vocab",
    "sample_row": with_(TURNS, texts())
    + """SELECT row_id, full_text AS text FROM texts WHERE split = 'train'
ORDER BY row_id LIMIT 1""",
    "id_prefix": labelled()
    + f"""SELECT row_id, {joined('ids[1:8]')} AS input_ids,
       {joined('list_transform(ids[1:8], lambda x: 1)')} AS mask FROM labelled""",
    "prompt_build": f"""SELECT item_id AS prompt_id, 'system' AS first_role,
       '{SYSTEM}' AS system_text, 'user' AS second_role, text AS user_text FROM benchmark""",
    "prompt_choice": """SELECT item_id AS prompt_id,
       CASE WHEN contains(text, chr(10)) THEN 'From a file: ' || text ELSE text END AS user_text
FROM benchmark""",
    "render_full": with_(TURNS, WHOLE_TEXTS) + "SELECT row_id, text FROM whole_texts",
    "render_prompt": with_(TURNS)
    + f"""SELECT row_id, string_agg(
         CASE WHEN turn = last_turn THEN {HEADER} ELSE rendered END, '' ORDER BY turn) AS text
FROM turns GROUP BY row_id""",
    "render_infer": with_(PROMPTS) + "SELECT prompt_id, text FROM prompts",
    "vocab_build": with_(TURNS, VOCAB) + "SELECT piece, id, n, is_special FROM vocab",
    "encode_ids": ENCODED,
    "encode_ids_by_join": ENCODED,
    "truncate_stats": with_(
        f"sizes AS (SELECT doc_id, len(regexp_extract_all(text, '{PAT}')) AS n FROM documents)"
    )
    + """SELECT doc_id, n AS n_pieces, least(n, 1024) AS kept_1024, least(n, 64) AS kept_64
FROM sizes""",
    "decode_ids": PROMPT_IDS
    + """SELECT prompt_id, coalesce(string_agg(piece, '' ORDER BY pos)
         FILTER (WHERE NOT coalesce(is_special, true)), '') AS text
FROM places LEFT JOIN vocab USING (piece) GROUP BY prompt_id""",
    "infer_inputs": PROMPT_IDS
    + f"""SELECT prompt_id, {joined('ids')} AS input_ids,
       {joined('list_transform(ids, lambda x: 1)')} AS attention_mask FROM ids""",
    "prompt_len": with_(TURNS, texts(), cut()) + "SELECT row_id, prompt_len FROM cut",
    "labels_by_length": labelled(eos=False)
    + f"SELECT row_id, {joined('labels')} AS labels FROM labelled",
    "labels_eos": labelled(column="tight")
    + f"SELECT row_id, {joined('labels')} AS labels FROM labelled",
    "labels_by_marker": BY_MARKER + f"SELECT row_id, {joined('labels')} AS labels FROM labelled",
    "split_counts": with_(SIZES)
    + """SELECT count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'validation') AS n_validation FROM sizes""",
    "active_labels": labelled()
    + f"""SELECT row_id, split, CAST(len(ids) AS BIGINT) AS n_tokens, {ACTIVE} AS n_active
FROM labelled""",
    "split_label_stats": labelled()
    + f"""SELECT split, count(*) AS n_rows, CAST(sum(len(ids)) AS BIGINT) AS n_tokens,
       CAST(sum({ACTIVE}) AS BIGINT) AS n_active, min({ACTIVE}) AS min_active,
       max({ACTIVE}) AS max_active, count(*) FILTER (WHERE {ACTIVE} = 0) AS n_without_labels
FROM labelled GROUP BY split""",
    "steps_per_epoch": with_(SIZES)
    + """SELECT count(*) FILTER (WHERE split = 'train') AS n_train,
       count(*) FILTER (WHERE split = 'train') // 16 AS n_steps FROM sizes""",
    "epoch_rows": with_(TURNS, texts(), cut())
    + """SELECT row_id, len(pieces) AS n_tokens, CAST(unnest([0, 1]) AS BIGINT) AS epoch
FROM cut WHERE split = 'train'""",
    "batch_assign": with_(PLAN) + "SELECT epoch, idx, row_id, batch_id FROM plan",
    "eval_batch_assign": with_(SIZES)
    + """SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS idx,
       (row_number() OVER (ORDER BY row_id) - 1) // 4 AS batch_id
FROM sizes WHERE split = 'validation'""",
    "step_assign": with_(PLAN) + "SELECT row_id, epoch, step FROM plan",
    "pad_batches": padded("right"),
    "pad_batches_left": padded("left"),
    "batch_sink": in_batches(),
    "step_manifest": LABELLED_PLAN
    + f""", batches AS (
  SELECT step, epoch, batch_id, count(*) AS n_rows, sum(len(ids)) AS n_tokens,
         sum({ACTIVE}) AS n_active, count(*) * max(len(ids)) AS n_padded
  FROM plan JOIN labelled USING (row_id) GROUP BY step, epoch, batch_id)
SELECT step, epoch, count(*) AS n_batches, CAST(sum(n_rows) AS BIGINT) AS n_rows,
       CAST(sum(n_tokens) AS BIGINT) AS n_tokens, CAST(sum(n_active) AS BIGINT) AS n_active,
       CAST(sum(n_padded) AS BIGINT) AS n_padded, (step + 1) % 2 = 0 AS logs,
       (step + 1) % 5 = 0 AS evaluates, (step + 1) % 10 = 0 AS saves
FROM batches GROUP BY step, epoch""",
    "resume_rows": with_(PLAN) + "SELECT row_id, epoch, step FROM plan WHERE step >= 3",
    "chat_prepare": labelled() + ROWS,
    "chat_prepare_marker": BY_MARKER + ROWS,
    "chat_prepare_roles": BY_ROLE + ROWS,
    "decode_roles": BY_ROLE
    + """SELECT row_id, coalesce(string_agg(piece, '' ORDER BY pos)
         FILTER (WHERE NOT coalesce(is_special, true)), '') AS text
FROM places LEFT JOIN vocab USING (piece) GROUP BY row_id""",
    "chat_prepare_files": labelled() + POSITIONED,
    "chat_prepare_files_tolerant": BY_MARKER + POSITIONED,
    "chat_prepare_files_capped": labelled() + POSITIONED + " QUALIFY idx < 20",
    "chat_quarantine": with_(SIZES) + QUARANTINE,
    "prepare_smoke": labelled()
    + f"""SELECT row_id, split, CAST(len(ids) AS BIGINT) AS n_tokens, {ACTIVE} AS n_active
FROM labelled WHERE split = 'train' ORDER BY row_id LIMIT 1""",
}
