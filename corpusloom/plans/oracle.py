"""The same answers in DuckDB's SQL, over the same tables, to check the queries against."""

from __future__ import annotations

import re

from corpusloom.functions.text import CHAT_TOKENS, UNICODE_SPACE, WORD_SPLIT
from corpusloom.plans.catalog import NUCLEUS, RUN_CONFIGS
from corpusloom.plans.tables import BATCH, CHUNK, LM_TOP, SEQ_LENGTH, VOCAB_SIZE, WORLD_SIZE

EOS = VOCAB_SIZE - 1
CHAT = {name: VOCAB_SIZE + i for i, name in enumerate(CHAT_TOKENS)}
EXAMPLE_LENGTH = SEQ_LENGTH
WEIGHT = 0.7

# The pattern engine here has no look-ahead. A mark in front of a white-space character
# that is followed by something visible says the same: a run of white space stops there.
MARK = r"\x01"
MARKED_SPLIT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d|(?:{MARK} )?\p{{L}}+|(?:{MARK} )?\p{{N}}+"
    rf"|(?:{MARK} )?[^{UNICODE_SPACE}\p{{L}}\p{{N}}{MARK}]+|{MARK}[{UNICODE_SPACE}]|[{UNICODE_SPACE}]+"
).replace("'", "''")


def split_text(text: str) -> str:
    marked = f"regexp_replace({text}, '([{UNICODE_SPACE}])([^{UNICODE_SPACE}])', chr(1) || '\\1\\2', 'g')"
    return f"list_transform(regexp_extract_all({marked}, '{MARKED_SPLIT}'), lambda p: replace(p, chr(1), ''))"


def byte_list(text: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::INT)"


def joined(ids: str) -> str:
    return f"array_to_string({ids}, ',')"


def hash60(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def ordering(seed: str, key: str) -> str:
    return f"md5({seed} || ':' || {key}) || ':' || {key}"


PART: dict[str, str] = {}  # named parts of a query, in order of dependence

PART["doc_parts"] = f"SELECT doc_id, {split_text('text')} AS ps FROM documents"
PART["doc_pieces"] = "SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM doc_parts"
PART["piece_counts"] = "SELECT piece, count(*) AS n FROM doc_pieces GROUP BY piece"
PART["vocab"] = f"""
    SELECT piece, (255 + row_number() OVER (ORDER BY n DESC, piece))::INT AS id FROM piece_counts
    WHERE octet_length(encode(piece)) > 1 QUALIFY row_number() OVER (ORDER BY n DESC, piece) <= {VOCAB_SIZE - 257}"""
PART["turn_parts"] = f"SELECT conv_id, turn, role, {split_text('text')} AS ps FROM conversations"
PART["turn_pieces"] = "SELECT conv_id, turn, role, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM turn_parts"
PART["pair_rows"] = """
    SELECT u.conv_id, u.turn AS user_turn, u.text AS instruction, a.text AS response, s.text AS context
    FROM conversations u
    LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
    LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system'
    WHERE u.role = 'user'"""
PART["dolly_sides"] = """
    SELECT conv_id, user_turn, response AS assistant,
           instruction || CASE WHEN coalesce(context, '') = '' THEN '' ELSE chr(10) || chr(10) || 'Context: ' || context END AS "user"
    FROM pair_rows WHERE coalesce(instruction, '') <> '' AND coalesce(response, '') <> ''"""
PART["side_parts"] = f"""
    SELECT conv_id, user_turn, {split_text('"user"')} AS ups, {split_text('assistant')} AS aps FROM dolly_sides"""
PART["side_pieces"] = """
    SELECT conv_id, user_turn, 'user' AS role, unnest(ups) AS piece, generate_subscripts(ups, 1) AS i FROM side_parts
    UNION ALL
    SELECT conv_id, user_turn, 'assistant', unnest(aps), generate_subscripts(aps, 1) FROM side_parts"""
PART["piece_ids"] = f"""
    SELECT p.piece, CASE WHEN v.id IS NOT NULL THEN [v.id] ELSE {byte_list('p.piece')} END AS ids
    FROM (@ALL_PIECES@) p LEFT JOIN vocab v ON v.piece = p.piece"""
PART["doc_ids"] = """
    SELECT doc_id, flatten(list(ids ORDER BY i)) AS ids FROM doc_pieces JOIN piece_ids USING (piece) GROUP BY doc_id"""
PART["coded"] = "SELECT doc_id, lang, source, text, ids FROM documents JOIN doc_ids USING (doc_id)"
PART["turn_coded"] = """
    SELECT conv_id, turn, any_value(role) AS role, flatten(list(ids ORDER BY i)) AS ids
    FROM turn_pieces JOIN piece_ids USING (piece) GROUP BY conv_id, turn"""
PART["framed"] = f"""
    SELECT conv_id, turn, role,
           [CASE role WHEN 'system' THEN {CHAT['system']} WHEN 'user' THEN {CHAT['user']} ELSE {CHAT['assistant']} END]
             || ids || [{CHAT['end_turn']}] AS ids,
           [0] || list_transform(range(len(ids) + 1), lambda x: CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) AS mask
    FROM turn_coded"""
PART["examples"] = f"""
    SELECT conv_id, user_turn,
           [{CHAT['user']}] || u || [{CHAT['end_turn']}, {CHAT['assistant']}] || a || [{CHAT['end_turn']}, {EOS}] AS ids,
           list_transform(range(len(u) + 3), lambda x: 0) || list_transform(range(len(a) + 1), lambda x: 1) || [0] AS mask
    FROM (SELECT conv_id, user_turn,
                 flatten(list(ids ORDER BY i) FILTER (WHERE role = 'user')) AS u,
                 flatten(list(ids ORDER BY i) FILTER (WHERE role = 'assistant')) AS a
          FROM side_pieces JOIN piece_ids USING (piece) GROUP BY conv_id, user_turn)
    WHERE len(u) + len(a) + 5 <= {2 * EXAMPLE_LENGTH}"""
PART["tensors"] = f"""
    SELECT conv_id, user_turn, len(ids) AS n, t[1:{SEQ_LENGTH}] AS x,
           list_transform(range(2, {SEQ_LENGTH + 2}), lambda i: CASE WHEN m[i] = 0 THEN -1 ELSE t[i] END) AS y
    FROM (SELECT *, list_resize(ids, {SEQ_LENGTH + 1}, 0) AS t, list_resize(mask, {SEQ_LENGTH + 1}, 0) AS m FROM examples)"""
PART["doc_order"] = f"""
    SELECT doc_id, {ordering("'42'", 'doc_id')} AS k, count(*) OVER () AS n FROM documents"""
PART["doc_split"] = """
    SELECT doc_id, k, row_number() OVER (ORDER BY k) - 1 AS position,
           CASE WHEN row_number() OVER (ORDER BY k) > n - greatest(floor(n * 0.005::DOUBLE), 1) THEN 'val' ELSE 'train' END AS split
    FROM doc_order"""
PART["stream"] = """
    SELECT split, start + i - 1 AS pos, ids[i] AS id FROM (
      SELECT split, ids, sum(len(ids)) OVER (PARTITION BY split ORDER BY k) - len(ids) AS start,
             unnest(range(1, len(ids) + 1)) AS i
      FROM coded JOIN doc_split USING (doc_id))"""
PART["chunks"] = f"""
    SELECT split, (pos // {CHUNK})::BIGINT AS chunk_id, min(pos)::BIGINT AS start_pos, count(*) AS n_tokens,
           list(id ORDER BY pos) AS tokens
    FROM stream GROUP BY split, pos // {CHUNK}"""
PART["triples"] = """
    SELECT split, coalesce(lag(id, 2) OVER w, -1) AS w1, coalesce(lag(id, 1) OVER w, -1) AS w2, id AS w3
    FROM stream WINDOW w AS (PARTITION BY split ORDER BY pos)"""
PART["targets"] = """
    SELECT conv_id, user_turn, i - 1 AS pos, CASE WHEN i = 1 THEN -1 ELSE x[i - 1] END AS w1, x[i] AS w2, y[i] AS w3
    FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM tensors)"""
PART["split_tensors"] = f"""
    SELECT *, CASE WHEN row_number() OVER (ORDER BY {ordering("'42'", "conv_id || ':' || user_turn")})
                        <= greatest(floor(count(*) OVER () * 0.2::DOUBLE), 1) THEN 'val' ELSE 'train' END AS split FROM tensors"""
PART["base"] = "SELECT w1, w2, w3, count(*)::DOUBLE AS n FROM triples WHERE split = 'train' GROUP BY ALL"
PART["trained"] = "SELECT * FROM base@TUNED@"
PART["summed"] = "SELECT w1, w2, w3, sum(n) AS n FROM trained GROUP BY ALL"
PART["c1"] = "SELECT w3, sum(n) AS c1 FROM trained GROUP BY w3"
PART["n1"] = "SELECT w2, sum(n) AS n1 FROM trained GROUP BY w2"
PART["c2"] = "SELECT w2, w3, sum(n) AS c2 FROM trained GROUP BY ALL"
PART["n2"] = "SELECT w1, w2, sum(n) AS n2 FROM trained GROUP BY ALL"
PART["windows"] = f"""
    SELECT window_id, "offset", t[1:{SEQ_LENGTH}] AS x, t[2:{SEQ_LENGTH + 1}] AS y
    FROM (SELECT window_id, "offset", list(id ORDER BY pos) AS t
          FROM (SELECT *, unnest(range("offset", "offset" + {SEQ_LENGTH + 1})) AS pos FROM
                (SELECT i AS window_id, {hash60("'0:0:' || i")} % ((SELECT count(*) FROM stream WHERE split = '@SPLIT@') - {SEQ_LENGTH + 1}) AS "offset"
                 FROM range((SELECT count(*) FROM documents)) r(i)))
          JOIN (SELECT pos, id FROM stream WHERE split = '@SPLIT@') USING (pos) GROUP BY ALL)"""
PART["conv_logits"] = """
    SELECT conv_id, id AS token_id, ln(count(*)::DOUBLE) AS logit
    FROM (SELECT conv_id, unnest(ids) AS id FROM turn_coded) GROUP BY ALL"""
PART["turn_logits"] = """
    SELECT conv_id, turn, id AS token_id, ln(count(*)::DOUBLE) AS logit
    FROM (SELECT conv_id, turn, unnest(ids) AS id FROM turn_coded) GROUP BY ALL"""
PART["turn_nll"] = """
    SELECT t.conv_id, t.turn, t.y, n.log_norm - l.logit AS nll
    FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN list_min(ids) ELSE -1 END AS y FROM turn_coded) t
    LEFT JOIN (SELECT conv_id, turn, ln(sum(exp(logit))) AS log_norm FROM turn_logits GROUP BY ALL) n USING (conv_id, turn)
    LEFT JOIN turn_logits l ON l.conv_id = t.conv_id AND l.turn = t.turn AND l.token_id = t.y"""
PART["steps"] = f"""
    SELECT event_type AS run, event_id AS step, value / 10 AS loss, (user_id % 50 + 1) / 100 AS dt,
           user_id % {WORLD_SIZE} AS rank, event_id // 8 AS batch_id FROM events"""
PART["batch_table"] = """
    SELECT run, rank, batch_id, avg(loss) AS loss, count(loss) AS n_targets FROM steps GROUP BY ALL"""
PART["turn_keys"] = """
    SELECT conv_id, turn, conv_id || ':' || turn AS k, count(*) OVER () AS n FROM conversations"""
PART["epochs"] = "SELECT @EPOCHS@ AS epochs"
PART["sharded"] = f"""
    SELECT conv_id, turn, epoch, (i % {WORLD_SIZE})::INT AS rank, i // {WORLD_SIZE} AS place, ceil(n / {WORLD_SIZE}) AS per_rank
    FROM (SELECT *, unnest(range(position, (ceil(n / {WORLD_SIZE}) * {WORLD_SIZE})::BIGINT, n)) AS i
          FROM (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY {ordering("'42:' || epoch", 'k')}) - 1 AS position
                FROM (SELECT *, unnest(range((SELECT epochs FROM epochs)))::INT AS epoch FROM turn_keys)))"""
PART["dealt"] = f"""
    SELECT conv_id, turn, epoch, rank, place // {BATCH} AS batch_id, (place % {BATCH})::INT AS slot
    FROM sharded WHERE place // {BATCH} < floor(per_rank / {BATCH})"""
PART["trimmed"] = f"""
    SELECT conv_id, turn, ids FROM (
      SELECT *, sum(len(ids)) OVER w AS used, row_number() OVER w AS back FROM framed
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING))
    WHERE used + 1 <= {SEQ_LENGTH} OR back = 1"""
PART["kept"] = """
    SELECT conv_id, token_id, logit / 0.7::DOUBLE AS logit FROM conv_logits
    QUALIFY rank() OVER (PARTITION BY conv_id ORDER BY logit DESC) <= 50"""
PART["kept_prob"] = """
    SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY conv_id) AS prob FROM kept"""
PART["inside"] = """
    SELECT conv_id, token_id, logit FROM kept_prob
    QUALIFY coalesce(sum(prob) OVER (PARTITION BY conv_id ORDER BY logit DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.9"""
PART["inside_prob"] = """
    SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY conv_id) AS prob FROM inside"""

P1 = f"({WEIGHT} * coalesce(c1, 0) / (SELECT sum(n) FROM trained) + {1 - WEIGHT}::DOUBLE / @V@)"
P2 = f"CASE WHEN n1 > 0 THEN {WEIGHT} * coalesce(c2, 0) / n1 + (1 - {WEIGHT}::DOUBLE) * {P1} ELSE {P1} END"
P3 = f"CASE WHEN n2 > 0 THEN {WEIGHT} * coalesce(t.n, 0) / n2 + (1 - {WEIGHT}::DOUBLE) * ({P2}) ELSE {P2} END"
LM_JOINS = """
    LEFT JOIN trained t USING (w1, w2, w3) LEFT JOIN n2 USING (w1, w2) LEFT JOIN c2 USING (w2, w3)
    LEFT JOIN n1 USING (w2) LEFT JOIN c1 USING (w3)"""


def log_prob(size: int) -> str:
    return f"ln({P3.replace('@V@', str(size))})"


def draws(probs: str, seed: int, order: str) -> str:
    """The first token whose cumulative probability passes the hashed draw."""
    u = f"{hash60(f'{chr(39)}{seed}:{chr(39)} || conv_id')}::DOUBLE / {2**60}::DOUBLE"
    return f"""
    SELECT conv_id, coalesce(arg_min(token_id, cum) FILTER (WHERE cum > u * top), arg_max(token_id, cum)) AS token_id
    FROM (SELECT *, {u} AS u, max(cum) OVER (PARTITION BY conv_id) AS top FROM (
      SELECT conv_id, token_id, sum(prob) OVER (PARTITION BY conv_id ORDER BY {order}, token_id ROWS UNBOUNDED PRECEDING) AS cum
      FROM {probs}))
    GROUP BY conv_id"""


def build(body: str, **replace: str) -> str:
    """Put the parts a body needs in front of it, in order."""
    def needs(text: str) -> set[str]:
        return {p for p in PART if re.search(rf"\b(FROM|JOIN)\s+{p}\b", text)}

    parts = dict(PART)
    for name, value in {"TUNED": "", **replace}.items():
        parts = {k: v.replace(f"@{name}@", value) for k, v in parts.items()}
    wanted, todo = set(), needs(body)
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo |= needs(parts[name]) - wanted
    tables = [p for p in ("doc_pieces", "turn_pieces", "side_pieces") if p in wanted]
    every = " UNION ".join(f"SELECT DISTINCT piece FROM {t}" for t in tables)
    chosen = [f"{n} AS MATERIALIZED ({parts[n].replace('@ALL_PIECES@', every)})" for n in parts if n in wanted]
    return f"WITH {', '.join(chosen)} {body}" if chosen else body


SQL: dict[str, str] = {}

SQL["corpus_by_source"] = "SELECT source, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY source"
SQL["subset_by_language"] = "SELECT lang, count(*) AS n_docs FROM documents WHERE lang IN ('de', 'es', 'fr') GROUP BY lang"
SQL["materialised_corpus"] = "SELECT doc_id, md5(text) AS digest FROM documents"
SQL["instruction_files"] = build(
    "SELECT count(*) AS n_rows, count(context) AS n_context, count(response) AS n_response, sum(length(instruction))::BIGINT AS n_chars FROM pair_rows"
)
SQL["prompt_tokens"] = build(f"SELECT conv_id || '-' || turn AS prompt_id, {joined('ids')} AS ids FROM turn_coded WHERE role = 'user'")
SQL["byte_tokens"] = f"SELECT doc_id, octet_length(encode(text))::INT AS n_tokens, {joined(byte_list('text'))} AS ids FROM documents"
SQL["subword_pieces"] = build("SELECT doc_id, len(ps)::INT AS n_pieces, array_to_string(ps, chr(1)) AS pieces FROM doc_parts")
SQL["word_counts"] = (
    f"SELECT piece, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{WORD_SPLIT}')) AS piece FROM documents) GROUP BY piece"
)
BASE_TOKENS = f"""
    SELECT i::INT AS token_id, lpad(hex(i), 2, '0') AS token, false AS is_special FROM range(256) r(i)
    UNION ALL SELECT id, hex(encode(piece)), false FROM vocab
    UNION ALL SELECT {EOS}, hex(encode('<|endoftext|>')), true"""
SQL["piece_vocabulary"] = build(
    BASE_TOKENS + "".join(f" UNION ALL SELECT {i}, hex(encode('{CHAT_TOKENS[n]}')), true" for n, i in CHAT.items())
)
SQL["saved_vocabulary"] = build(BASE_TOKENS)
SQL["document_tokens"] = build(f"SELECT doc_id, {joined('ids')} AS ids FROM coded")
SQL["turn_tokens_with_eos"] = build(f"SELECT conv_id, turn, {joined(f'ids || [{EOS}]')} AS ids FROM turn_coded")
PART_SPECIAL = f"""
    SELECT conv_id, turn, CASE role WHEN 'system' THEN {CHAT['system']} WHEN 'user' THEN {CHAT['user']} ELSE {CHAT['assistant']} END
           || ',' || {joined('ids')} || ',32,{CHAT['end_turn']}' AS ids FROM turn_coded"""
SQL["special_tokens_in_text"] = build(PART_SPECIAL)
SQL["decoded_documents"] = "SELECT doc_id, text FROM documents"
SQL["learned_tokens_decoded"] = SQL["decoded_documents"]
SQL["compression_by_language"] = build(
    """SELECT lang, count(*) AS n_texts, sum(length(text))::BIGINT AS n_chars, sum(octet_length(encode(text)))::BIGINT AS n_bytes,
       sum(len(ids))::BIGINT AS n_tokens, round(sum(len(ids)) / sum(length(text)), 6) AS tokens_per_char,
       round(avg(length(text)), 6) AS avg_chars, round(avg(len(ids)), 6) AS avg_tokens FROM coded GROUP BY lang"""
)
SQL["shuffled_documents"] = build("SELECT doc_id, position FROM doc_split")
SQL["corpus_split"] = build("SELECT doc_id, split FROM doc_split")
SQL["split_token_counts"] = build(
    "SELECT split, count(*) AS n_docs, sum(octet_length(encode(text)))::BIGINT AS n_tokens FROM documents JOIN doc_split USING (doc_id) GROUP BY split"
)
SQL["split_subword_counts"] = build(
    "SELECT split, count(*) AS n_docs, sum(len(ids))::BIGINT AS n_tokens FROM coded JOIN doc_split USING (doc_id) GROUP BY split"
)
SQL["tokens_by_source"] = build(
    """SELECT source, lang, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens, min(n) AS min_tokens, max(n) AS max_tokens,
       round(avg(n), 6) AS avg_tokens, quantile_disc(n, 0.25) AS p25, quantile_disc(n, 0.5) AS p50, quantile_disc(n, 0.75) AS p75
       FROM (SELECT source, lang, len(ids) AS n FROM coded) GROUP BY source, lang"""
)
SQL["token_stream"] = build(f"SELECT split, chunk_id, start_pos, n_tokens, {joined('tokens')} AS tokens FROM chunks")
SQL["stream_table"] = SQL["token_files"] = SQL["token_stream"]
SQL["stream_lengths"] = build("SELECT split, count(*) AS n_tokens FROM stream GROUP BY split")
SQL["training_windows"] = build(
    f'SELECT window_id, "offset", {joined("x")} AS x, {joined("y")} AS y FROM windows', SPLIT="train"
)
SQL["selected_documents"] = build(
    "SELECT doc_id, lang, position FROM documents JOIN doc_split USING (doc_id) WHERE split = 'train'"
)
SQL["picked_documents"] = build("SELECT doc_id, position, position * 2 + i AS slot FROM doc_split, range(2) r(i)")
SQL["dolly_chat"] = build('SELECT conv_id, user_turn AS turn, "user", assistant FROM dolly_sides')
SQL["alpaca_chat"] = build(
    """SELECT conv_id, user_turn AS turn, replace("user", 'Context: ' || context, 'Input: ' || context) AS "user", assistant
       FROM (SELECT d.*, p.context FROM dolly_sides d JOIN pair_rows p USING (conv_id, user_turn)) WHERE context IS NOT NULL
       UNION ALL SELECT conv_id, user_turn, "user", assistant FROM dolly_sides JOIN pair_rows p USING (conv_id, user_turn) WHERE context IS NULL"""
)
SQL["generic_chat"] = build(
    """SELECT conv_id, user_turn AS turn, instruction AS "user", response AS assistant FROM pair_rows
       WHERE context IS NULL AND coalesce(instruction, '') <> '' AND coalesce(response, '') <> ''"""
)
SQL["mixed_chat"] = build(
    """SELECT conv_id, user_turn AS turn, response AS assistant, CASE WHEN context IS NULL OR conv_id % 3 = 2 THEN instruction
         ELSE instruction || chr(10) || chr(10) || (CASE conv_id % 3 WHEN 0 THEN 'Context: ' ELSE 'Input: ' END) || context END AS "user"
       FROM pair_rows WHERE coalesce(instruction, '') <> '' AND coalesce(response, '') <> ''"""
)
SQL["dataset_styles"] = build(
    "SELECT ['dolly', 'alpaca', 'generic'][conv_id % 3 + 1] AS style, count(*) AS n_rows FROM pair_rows GROUP BY 1"
)
SQL["preparation_counts"] = build(
    """SELECT (SELECT count(*) FROM examples) AS written, (SELECT count(*) FROM pair_rows) - (SELECT count(*) FROM examples) AS skipped,
       (SELECT sum(len(ids)) FROM examples)::BIGINT AS tokens_written"""
)
SQL["preparation_counts_on_write"] = SQL["preparation_counts"]
SQL["instruction_examples"] = build(f"SELECT conv_id, user_turn, {joined('ids')} AS ids, {joined('mask')} AS mask FROM examples")
SQL["example_files"] = build(f"SELECT {joined('ids')} AS ids, {joined('mask')} AS mask FROM examples")
EXAMPLE_ORDER = ordering("'42'", "conv_id || ':' || user_turn")
SQL["example_split"] = build(
    f"""SELECT conv_id, user_turn AS turn, CASE WHEN row_number() OVER (ORDER BY {EXAMPLE_ORDER}) <= greatest(floor(count(*) OVER () * 0.02::DOUBLE), 1)
        THEN 'val' ELSE 'train' END AS split FROM pair_rows"""
)
SQL["example_tensors"] = build(
    f"""SELECT conv_id, user_turn, CASE WHEN row_number() OVER (ORDER BY {EXAMPLE_ORDER}) <= greatest(floor(count(*) OVER () * 0.02::DOUBLE), 1)
        THEN 'val' ELSE 'train' END AS split, {joined('x')} AS x, {joined('y')} AS y FROM tensors"""
)
SQL["example_validity"] = build(
    f"""SELECT count(*) AS n_examples, count(*) FILTER (WHERE n > {SEQ_LENGTH + 1}) AS n_truncated,
        count(*) FILTER (WHERE k = 0) AS n_fully_masked, sum(k)::BIGINT AS n_trained, round(sum(k) / (count(*) * {SEQ_LENGTH}), 6) AS trained_share
        FROM (SELECT n, len(list_filter(y, lambda t: t <> -1)) AS k FROM tensors)"""
)
SQL["encoded_turns"] = build(f"SELECT conv_id, turn, {joined('ids')} AS ids, {joined('mask')} AS mask FROM framed")
SQL["encoded_conversations"] = build(
    f"""SELECT conv_id, {joined(f'flatten(list(ids ORDER BY turn)) || [{EOS}]')} AS ids, {joined('flatten(list(mask ORDER BY turn)) || [0]')} AS mask
        FROM framed GROUP BY conv_id HAVING sum(len(ids)) + 1 <= {SEQ_LENGTH * 4}"""
)
SQL["trimmed_history"] = build("SELECT conv_id, turn FROM trimmed")
SQL["chat_prompts"] = build(
    f"SELECT conv_id, {joined(f'flatten(list(ids ORDER BY turn)) || [{CHAT["assistant"]}]')} AS ids FROM trimmed GROUP BY conv_id"
)
SQL["cut_replies"] = f"""
    SELECT conv_id, turn, regexp_replace(regexp_replace(text, '^[{UNICODE_SPACE}]+', ''), '[{UNICODE_SPACE}]+$', '') AS reply
    FROM conversations WHERE role = 'assistant'"""
SQL["continued_conversations"] = """
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT conv_id, max(turn) + 1, 'assistant', arg_max(text, turn) FROM conversations GROUP BY conv_id"""
SQL["spoken_turns"] = f"""
    SELECT conv_id, turn, role, regexp_replace(regexp_replace(text, '^[{UNICODE_SPACE}]+', ''), '[{UNICODE_SPACE}]+$', '') AS text
    FROM conversations WHERE role <> 'system'"""
SQL["rank_shards"] = build("SELECT conv_id, turn, epoch, rank, place FROM sharded", EPOCHS="2")
SQL["training_batches"] = build("SELECT conv_id, turn, epoch, rank, batch_id, slot FROM dealt", EPOCHS="1")
SQL["evaluation_batches"] = build(
    "SELECT rank, batch_id, count(*) AS n_rows FROM dealt WHERE batch_id < 10 GROUP BY ALL", EPOCHS="1"
)
PER_EPOCH = f"(SELECT floor(ceil(count(*) / {WORLD_SIZE}) / {BATCH})::BIGINT FROM conversations)"
MICRO = "(SELECT count(*) // 8 * 2 FROM conversations)"
SQL["step_schedule"] = build(
    f"""SELECT m.i // 2 AS step, (m.i % 2)::INT AS micro_step, d.* FROM range({MICRO}) m(i)
        JOIN dealt d ON d.epoch = m.i // {PER_EPOCH} AND d.batch_id = m.i % {PER_EPOCH}""",
    EPOCHS=f"ceil({MICRO} / {PER_EPOCH})::BIGINT",
)
EXAMPLE_EPOCH = ordering("'42:0'", "conv_id || ':' || user_turn")
SQL["batched_tensors"] = build(
    f"""SELECT conv_id, user_turn, (i % {WORLD_SIZE})::INT AS rank, i // {WORLD_SIZE} // {BATCH} AS batch_id, (i // {WORLD_SIZE} % {BATCH})::INT AS slot,
        {joined('x')} AS x, {joined('y')} AS y
        FROM (SELECT *, unnest(range(p, (ceil(n / {WORLD_SIZE}) * {WORLD_SIZE})::BIGINT, n)) AS i
              FROM (SELECT conv_id, user_turn, x, y, count(*) OVER () AS n, row_number() OVER (ORDER BY {EXAMPLE_EPOCH}) - 1 AS p FROM tensors))
        WHERE i // {WORLD_SIZE} // {BATCH} < floor(ceil(n / {WORLD_SIZE}) / {BATCH})"""
)
SQL["masked_cross_entropy"] = build("SELECT conv_id, turn, y, round(nll, 6) AS nll FROM turn_nll")
SQL["batch_loss"] = build(
    "SELECT conv_id, count(nll) = 0 AS no_loss, round(avg(nll), 6) AS loss, count(nll) AS n_targets FROM turn_nll GROUP BY conv_id"
)
SQL["validation_loss"] = build(
    """SELECT round(avg(loss), 6) AS loss, count(*) AS n_batches, round(exp(least(avg(loss), 20)), 4) AS perplexity,
       round(exp(least(avg(loss), 100)), 4) AS perplexity_eval FROM batch_table"""
)
SQL["loss_by_run"] = build(
    """SELECT run, round(avg(loss), 6) AS loss, count(*) AS n_batches, round(sum(loss * n_targets) / sum(n_targets), 6) AS weighted_loss
       FROM batch_table GROUP BY run"""
)
SQL["loss_over_ranks"] = build(
    "SELECT run, round(avg(loss), 6) AS loss, count(*) AS n_ranks FROM (SELECT run, rank, avg(loss) AS loss FROM batch_table GROUP BY ALL) GROUP BY run"
)
SQL["step_loss"] = build("SELECT run, batch_id, round(sum(loss / 8), 6) AS loss FROM steps GROUP BY ALL")
PER_STEP = BATCH * SEQ_LENGTH * WORLD_SIZE
SQL["run_progress"] = build(
    f"""SELECT run, step, tokens, elapsed, round({PER_STEP}::DOUBLE / dt, 4) AS tokens_per_sec,
        round(tokens / {PER_STEP * 1_000_000}::DOUBLE * 100, 8) AS percent,
        CASE WHEN step > first_step THEN round(elapsed / greatest(step - first_step, 1) * (1000000 - step), 6) END AS eta
        FROM (SELECT *, (count(*) OVER w * {PER_STEP})::BIGINT AS tokens, (sum(dt) OVER w)::BIGINT AS elapsed, min(step) OVER (PARTITION BY run) AS first_step
              FROM (SELECT run, step, round(dt * 100)::BIGINT AS dt FROM steps) WINDOW w AS (PARTITION BY run ORDER BY step ROWS UNBOUNDED PRECEDING))"""
)
SQL["best_evaluations"] = build(
    """SELECT run, step, round(loss, 6) AS val_loss, loss < coalesce(prev, 'inf'::DOUBLE) AS is_best, round(least(loss, prev), 6) AS best_loss
       FROM (SELECT *, min(loss) OVER (PARTITION BY run ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM steps)"""
)
SQL["run_summaries"] = build(
    """SELECT run, best_loss, best_step, last_step, last_loss, (SELECT count(*) FROM steps s WHERE s.run = b.run AND s.step > b.best_step AND s.loss > b.raw) AS n_worse,
       (SELECT min(step) FROM steps s WHERE s.run = b.run AND s.step > b.best_step AND s.loss > b.raw) AS diverged_at
       FROM (SELECT run, min(loss) AS raw, round(min(loss), 6) AS best_loss,
                    (SELECT min(step) FROM steps i WHERE i.run = o.run AND i.loss = min(o.loss)) AS best_step,
                    max(step) AS last_step, round(arg_max(loss, step), 6) AS last_loss
             FROM steps o GROUP BY run) b"""
)
SQL["clipped_steps"] = f"""
    SELECT user_id % {WORLD_SIZE} AS run, count(*) FILTER (WHERE event_type <> 'error') AS n_logged,
           count(*) FILTER (WHERE event_type = 'error') AS n_off,
           count(*) FILTER (WHERE event_type <> 'error' AND value > 20) AS n_clipped,
           round(count(*) FILTER (WHERE event_type <> 'error' AND value > 20) / count(*) FILTER (WHERE event_type <> 'error'), 6) AS clipped_share
    FROM events GROUP BY 1"""
PLAN_VALUES = ", ".join(
    f"('{c['name']}', {c['seq_length']}, {c['batch_size']}, {c['grad_accum_steps']}, {c['max_steps']})" for c in RUN_CONFIGS
)
SQL["run_plans"] = f"""
    SELECT d.*, c.*, (batch_size * {WORLD_SIZE} * grad_accum_steps)::BIGINT AS effective_batch,
           (batch_size * seq_length * {WORLD_SIZE} * grad_accum_steps)::BIGINT AS tokens_per_step,
           (batch_size * seq_length * {WORLD_SIZE} * grad_accum_steps)::BIGINT * max_steps AS target_tokens,
           round((batch_size * seq_length * {WORLD_SIZE} * grad_accum_steps)::BIGINT * max_steps / n_tokens, 6) AS corpus_passes
    FROM (SELECT count(*) AS n_docs, sum(octet_length(encode(text)))::BIGINT AS n_tokens FROM documents) d,
         (VALUES {PLAN_VALUES}) c(name, seq_length, batch_size, grad_accum_steps, max_steps)"""
SQL["loss_trends"] = build(
    """SELECT run, step, round(r, 6) AS avg_recent, round(o, 6) AS avg_older,
       CASE WHEN o IS NULL THEN '' WHEN r < o THEN '↓' WHEN r > o * 1.01::DOUBLE THEN '↑' ELSE '→' END AS trend
       FROM (SELECT run, step, avg(loss) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS r,
                    CASE WHEN row_number() OVER w >= 50 THEN avg(loss) OVER (w ROWS BETWEEN 49 PRECEDING AND 10 PRECEDING) END AS o
             FROM steps WINDOW w AS (PARTITION BY run ORDER BY step))"""
)
RATE = """CASE WHEN step < warm THEN 6e-4 * (step + 1) / warm WHEN step >= last THEN 6e-5
    ELSE 6e-5 + (6e-4 - 6e-5) * 0.5 * (1 + cos(pi() * (step - warm) / (last - warm))) END"""
RATES = f"(SELECT run, step, {RATE} AS lr FROM steps, (SELECT max(step) AS last, max(step) // 20 AS warm FROM steps))"
SQL["learning_rates"] = build(f"SELECT run, step, round(lr * 1e6, 6) AS lr_micro FROM {RATES}")
SQL["schedule_deviations"] = build(
    "SELECT run, count(*) AS n, CASE WHEN run = 'error' THEN count(*) ELSE 0 END AS n_off FROM steps GROUP BY run"
)
SQL["elapsed_times"] = """
    SELECT event_id, CASE WHEN event_id < 60 THEN event_id || 's'
             WHEN event_id < 3600 THEN round_even(event_id / 60, 0)::BIGINT || 'm'
             ELSE (event_id // 3600) || 'h' || lpad((event_id % 3600 // 60)::VARCHAR, 2, '0') || 'm' END AS elapsed,
           CASE WHEN event_id < 60 THEN event_id WHEN event_id < 3600 THEN round_even(event_id / 60, 0)::BIGINT * 60
             ELSE event_id // 60 * 60 END AS seconds
    FROM events"""
SQL["evaluations_with_train_loss"] = build(
    """SELECT e.step, round(e.loss, 6) AS val_loss, round(t.recent, 6) AS train_loss FROM (SELECT * FROM steps WHERE run = 'purchase') e
       ASOF LEFT JOIN (SELECT step, avg(loss) OVER (ORDER BY step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS recent
                       FROM steps WHERE run <> 'purchase') t ON e.step >= t.step"""
)
SQL["save_points"] = build(
    """SELECT run, step, step = last AS final FROM (SELECT run, step, max(step) OVER (PARTITION BY run) AS last FROM steps)
       WHERE step = last OR (step > 0 AND step % 100 = 0)"""
)
SQL["log_points"] = build(
    """SELECT run, step, 'log' AS kind FROM steps WHERE step % 10 = 0
       UNION ALL SELECT run, step, 'eval' FROM steps WHERE step % 500 = 0 AND step > 0"""
)
SECONDS = """CASE WHEN event_id < 60 THEN event_id WHEN event_id < 3600 THEN round_even(event_id / 60, 0)::BIGINT * 60
    ELSE event_id // 60 * 60 END"""
SQL["logged_steps"] = f"""
    SELECT event_id AS step, round(value / 10, 4) AS loss, round((user_id + 1) / 1000000, 9) AS lr,
           CASE WHEN event_type = 'error' THEN 'N/A' ELSE printf('%.4f', value) END AS grad_norm, user_id * 1000 AS tok_per_sec,
           round(value, 2) AS dt, (event_id + 1) * 196608 AS tok, {SECONDS} AS elapsed, 0::BIGINT AS run FROM events"""
SQL["logged_runs"] = """
    SELECT user_id % 4 AS part, r AS run, count(*) AS n_steps, min(event_id) AS first_step, max(event_id) AS last_step
    FROM events, range(2) t(r) GROUP BY ALL"""
SQL["logged_evaluations"] = f"""
    SELECT event_id AS step, round(value / 10, 4) AS val_loss, round(value, 2) AS perplexity, round(value / 10 + 1, 4) AS train_loss,
           round(value / 10, 4) AS best_val_loss, event_id * 1000 AS tok, {SECONDS} AS elapsed FROM events"""
SQL["logged_samples"] = """
    SELECT conv_id AS step, row_number() OVER (PARTITION BY conv_id ORDER BY turn)::INT AS sample, role AS prompt, text AS output FROM conversations"""
SQL["top_k_tokens"] = build("SELECT conv_id, token_id, round(logit, 6) AS logit FROM kept")
SQL["token_probabilities"] = build(
    "SELECT conv_id, token_id, round(exp(logit) / sum(exp(logit)) OVER (PARTITION BY conv_id), 9) AS prob FROM conv_logits"
)
SQL["nucleus_tokens"] = build(
    f"""SELECT conv_id, token_id FROM (SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY conv_id) AS prob FROM conv_logits)
       QUALIFY coalesce(sum(prob) OVER (PARTITION BY conv_id ORDER BY logit DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < {NUCLEUS}"""
)
SQL["next_token_distribution"] = build("SELECT conv_id, token_id, round(prob, 9) AS prob FROM inside_prob")
SQL["drawn_tokens"] = build(draws("inside_prob", 7, "logit DESC"))
SAMPLED = """(SELECT conv_id, token_id, prob, logit FROM
    (SELECT conv_id, token_id, logit, exp(logit / 0.8) / sum(exp(logit / 0.8)) OVER (PARTITION BY conv_id) AS prob FROM conv_logits)
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY logit DESC, token_id) <= 40)"""
SQL["sampled_tokens"] = build(draws(SAMPLED, 11, "logit DESC"))
SQL["trigram_counts"] = build("SELECT w1, w2, w3, n FROM trained")
SQL["finetuned_counts"] = build(
    "SELECT w1, w2, w3, sum(n) AS n FROM trained GROUP BY ALL",
    TUNED=" UNION ALL SELECT w1, w2, w3, 2.0::DOUBLE FROM targets WHERE w3 <> -1",
)
SQL["finetuned_loss"] = build(
    f"""SELECT conv_id, user_turn, round(avg(-lp), 6) AS loss, count(lp) AS n_targets
        FROM (SELECT s.conv_id, s.user_turn, p.lp FROM split_tensors s LEFT JOIN
              (SELECT conv_id, user_turn, {log_prob(VOCAB_SIZE + 4)} AS lp
               FROM (SELECT * FROM targets WHERE w3 <> -1) {LM_JOINS.replace('trained t', 'summed t')}) p USING (conv_id, user_turn)
              WHERE s.split = 'val') GROUP BY ALL""",
    TUNED=" UNION ALL SELECT w1, w2, w3, 1.0::DOUBLE FROM targets JOIN split_tensors USING (conv_id, user_turn) WHERE w3 <> -1 AND split = 'train'",
)
SQL["next_candidates"] = build(
    f"""SELECT w1, w2, token_id, round(exp(logit) / sum(exp(logit)) OVER (PARTITION BY w1, w2), 9) AS prob FROM (
          SELECT w1, w2, w3 AS token_id, {log_prob(VOCAB_SIZE)} AS logit FROM (SELECT w1, w2, w3 FROM (
            SELECT DISTINCT coalesce(ids[len(ids) - 1], -1) AS w1, coalesce(ids[len(ids)], -1) AS w2
            FROM (SELECT conv_id, arg_max(ids, turn) AS ids FROM turn_coded GROUP BY conv_id)) x,
            (SELECT v::INT AS w3 FROM range({VOCAB_SIZE}) r(v)) y) {LM_JOINS}
          QUALIFY rank() OVER (PARTITION BY w1, w2 ORDER BY logit DESC) <= {LM_TOP})"""
)
SQL["resumed_counts"] = build("SELECT w1, w2, w3, count(*)::DOUBLE AS n, 1 AS step FROM triples GROUP BY ALL")
SQL["token_scores"] = build(
    f"""SELECT conv_id, user_turn, pos::INT AS pos, round({log_prob(VOCAB_SIZE + 4)}, 6) AS log_prob
        FROM (SELECT * FROM targets WHERE w3 <> -1) {LM_JOINS} """
)
WINDOW_TARGETS = f"""(SELECT p // {8 * SEQ_LENGTH} AS batch_id, CASE WHEN p % {SEQ_LENGTH} = 0 THEN -1 ELSE v[p] END AS w1, v[p + 1] AS w2, v[p + 2] AS w3
    FROM (SELECT flatten(list(tokens ORDER BY start_pos)) AS v FROM chunks WHERE split = 'val'), range(len(v) - 1) r(p))"""
SQL["held_out_loss"] = build(
    f"""SELECT round(avg(loss), 6) AS loss, count(*) AS n_batches, round(exp(least(avg(loss), 100)), 3) AS perplexity
        FROM (SELECT batch_id, avg(-{log_prob(VOCAB_SIZE)}) AS loss FROM {WINDOW_TARGETS} {LM_JOINS} GROUP BY batch_id)""",
    SPLIT="val",
)
def weighted(weight: float) -> str:
    """The log-probability of a model that trusts each order by ``weight``."""
    return log_prob(VOCAB_SIZE).replace(f"{1 - WEIGHT}::DOUBLE", f"{1 - weight}::DOUBLE").replace(str(WEIGHT), str(weight))


VERSION_LOSSES = " UNION ALL ".join(
    f"""SELECT {step} AS step, avg(loss) AS loss
        FROM (SELECT batch_id, avg(-{weighted(w)}) AS loss FROM {WINDOW_TARGETS} {LM_JOINS} GROUP BY batch_id)"""
    for step, w in enumerate((0.5, 0.7, 0.9))
)
SQL["best_version"] = build(
    f"""SELECT step, round(loss, 6) AS val_loss, loss = min(loss) OVER () AS best,
          [0.5, 0.7, 0.9][1 + first_value(step) OVER (ORDER BY loss, step ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)]::DOUBLE AS best_weight
        FROM ({VERSION_LOSSES})"""
)
SQL["untrained_perplexity"] = build(f"SELECT count(DISTINCT chunk_id) AS n_batches, {VOCAB_SIZE}::DOUBLE AS perplexity FROM chunks")


def generated(prompts: str, size: int, steps: int, seed: int, model: str, kept: str, ranked: str) -> str:
    """CTEs that unroll ``steps`` draws; the last is ``made(key, ids, new)``.

    ``kept`` cuts ``(w1, w2, token_id, logit)`` to the tokens that may be drawn with their ``prob``.
    """
    parts = [
        f"""state0 AS MATERIALIZED (SELECT key, ids, coalesce(ids[len(ids) - 1], -1) AS w1, coalesce(ids[len(ids)], -1) AS w2, []::INT[] AS new
            FROM ({prompts}))"""
    ]
    for i in range(steps):
        offered = f"""SELECT w1, w2, w3 AS token_id, {log_prob(size)} AS logit
            FROM (SELECT w1, w2, w3 FROM (SELECT DISTINCT w1, w2 FROM state{i}) x, (SELECT v::INT AS w3 FROM range({size}) r(v)) y) {model}"""
        parts.append(f"offered{i} AS MATERIALIZED ({offered})")
        parts.append(f"kept{i} AS MATERIALIZED ({kept.replace('@OFFERED@', f'offered{i}')})")
        parts.append(f"""cum{i} AS MATERIALIZED (
            SELECT w1, w2, list({{'cum': cum, 'id': token_id}} ORDER BY cum, token_id) AS c FROM (
              SELECT *, sum(prob) OVER (PARTITION BY w1, w2 ORDER BY {ranked} DESC, token_id ROWS UNBOUNDED PRECEDING) AS cum FROM kept{i})
            GROUP BY w1, w2)""")
        u = f"{hash60(f'{chr(39)}{seed}:{chr(39)} || key || {chr(39)}:{i}{chr(39)}')}::DOUBLE / {2**60}::DOUBLE"
        parts.append(f"""state{i + 1} AS MATERIALIZED (
            SELECT key, ids, w2 AS w1, id AS w2, list_append(new, id) AS new FROM (
              SELECT s.*, coalesce(list_filter(c, lambda x: x.cum > {u} * c[len(c)].cum)[1].id, c[len(c)].id) AS id
              FROM state{i} s JOIN cum{i} USING (w1, w2)))""")
    parts.append(f"made AS (SELECT key, ids, new FROM state{steps})")
    return ", ".join(parts)


NUCLEUS_KEPT = """
    WITH a AS (SELECT w1, w2, token_id, logit / 0.7::DOUBLE AS logit FROM @OFFERED@
               QUALIFY rank() OVER (PARTITION BY w1, w2 ORDER BY logit / 0.7::DOUBLE DESC) <= 50),
         b AS (SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY w1, w2) AS prob FROM a),
         d AS (SELECT w1, w2, token_id, logit FROM b QUALIFY coalesce(sum(prob) OVER (PARTITION BY w1, w2 ORDER BY logit DESC, token_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 0.9)
    SELECT *, exp(logit) / sum(exp(logit)) OVER (PARTITION BY w1, w2) AS prob FROM d"""
SAMPLE_KEPT = """
    SELECT w1, w2, token_id, logit, exp(logit / 0.8) AS prob FROM @OFFERED@
    QUALIFY row_number() OVER (PARTITION BY w1, w2 ORDER BY logit DESC, token_id) <= 40"""
PROMPTS = "SELECT conv_id || '-' || turn AS key, ids FROM turn_coded WHERE role = 'user'"
# Valid UTF-8 sequences in hex, then the longest beginnings of one, then any single byte.
VALID = "[0-7].|(?:C[2-9A-F]|D.)[89AB].|(?:E0[AB].|E[1-9A-CEF][89AB].|ED[89].)[89AB].|(?:F0[9AB].|F[1-3][89AB].|F48.)[89AB].[89AB]."
PART_OF = "(?:E0[AB].|E[1-9A-CEF][89AB].|ED[89].)|(?:F0[9AB].|F[1-3][89AB].|F48.)[89AB].|(?:F0[9AB].|F[1-3][89AB].|F48.)"


def spelled(ids: str, size: int) -> str:
    """Text of a list of ids; bytes that are no UTF-8 become U+FFFD, one for each broken sequence."""
    token = f"CASE WHEN i < 256 THEN lpad(hex(i), 2, '0') WHEN i = {EOS} THEN hex(encode('<|endoftext|>')) ELSE (SELECT hex(encode(piece)) FROM vocab WHERE id = i) END"
    for name, i in CHAT.items():
        token = token.replace("ELSE", f"WHEN i = {i} THEN hex(encode('{CHAT_TOKENS[name]}')) ELSE", 1)
    return f"""(SELECT decode(unhex(coalesce(string_agg(CASE WHEN regexp_full_match(s, '{VALID}') THEN s ELSE 'EFBFBD' END, '' ORDER BY k), '')))
        FROM (SELECT unnest(a) AS s, generate_subscripts(a, 1) AS k FROM (SELECT regexp_extract_all(string_agg({token}, '' ORDER BY j), '{VALID}|{PART_OF}|..') AS a
              FROM (SELECT unnest({ids}) AS i, generate_subscripts({ids}, 1) AS j))))"""


GENERATED = "SELECT * FROM (WITH @CTES@ SELECT @SELECT@)"


def generation(select: str, ctes: str, needs: str, **replace: str) -> str:
    """``needs`` names the parts that the unrolled steps read."""
    body = GENERATED.replace("@CTES@", ctes).replace("@SELECT@", select)
    return build(body + f" /* {needs} */", **replace)


LM_PARTS = "FROM trained FROM n2 FROM c2 FROM n1 FROM c1 FROM turn_coded FROM vocab"
SQL["generated_tokens"] = generation(
    f"key AS prompt_id, {joined('ids || new')} AS ids FROM made",
    generated(PROMPTS, VOCAB_SIZE, 4, 3, LM_JOINS, NUCLEUS_KEPT, "logit"),
    LM_PARTS,
)
for name, kept, ranked in (("prompt_completions", NUCLEUS_KEPT, "logit"), ("training_samples", SAMPLE_KEPT, "logit")):
    SQL[name] = generation(
        f"""key AS prompt_id, (SELECT text FROM conversations c WHERE c.conv_id || '-' || c.turn = key) AS prompt,
            {spelled('made.ids || made.new', VOCAB_SIZE)} AS completion FROM made""",
        generated(PROMPTS, VOCAB_SIZE, 4, 0, LM_JOINS, kept, ranked),
        LM_PARTS,
    )
CHAT_PROMPTS = f"""
    SELECT conv_id::VARCHAR AS key, flatten(list(ids ORDER BY turn)) || [{CHAT['assistant']}] AS ids FROM (
      SELECT *, sum(len(ids)) OVER w AS used, row_number() OVER w AS back FROM framed
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn DESC ROWS UNBOUNDED PRECEDING))
    WHERE used + 1 <= {SEQ_LENGTH * 2 - 6} OR back = 1 GROUP BY conv_id"""
CUT = f"list_slice(new, 1, least(coalesce(list_position(new, {CHAT['end_turn']}), 99), coalesce(list_position(new, {EOS}), 99)) - 1)"
SQL["chat_replies"] = generation(
    f"""conv_id, turn, role, text FROM conversations
        UNION ALL SELECT conv_id, max(turn) + 1, 'assistant', any_value(trim(reply, chr(32) || chr(9) || chr(10) || chr(13))) FROM conversations
        JOIN (SELECT key, {spelled('cut', VOCAB_SIZE)} AS reply FROM (SELECT key, {CUT} AS cut FROM made)) ON key = conv_id::VARCHAR GROUP BY conv_id""",
    generated(CHAT_PROMPTS, VOCAB_SIZE + 4, 6, 0, LM_JOINS.replace("trained t", "summed t"), NUCLEUS_KEPT, "logit"),
    LM_PARTS + " FROM summed FROM framed",
    TUNED=" UNION ALL SELECT w1, w2, w3, 4.0::DOUBLE FROM targets WHERE w3 <> -1",
)


def merges(n: int) -> str:
    """CTEs that learn ``n`` merges one at a time: ``words{n}(piece, word, n)`` and ``tok{n}(c, h)``."""
    parts = [
        f"""words0 AS MATERIALIZED (SELECT piece, array_to_string(list_transform({byte_list('piece')}, lambda b: chr(b)), '') AS word, n FROM piece_counts)""",
        "tok0 AS MATERIALIZED (SELECT chr(i::INT) AS c, lpad(hex(i), 2, '0') AS h FROM range(256) r(i))",
    ]
    for i in range(n):
        parts.append(f"""best{i} AS MATERIALIZED (
            SELECT substr(word, p, 2) AS pair FROM (SELECT word, n, unnest(range(1, length(word))) AS p FROM words{i})
            GROUP BY pair ORDER BY sum(n) DESC, substr(pair, 1, 1), substr(pair, 2, 1) LIMIT 1)""")
        parts.append(f"""words{i + 1} AS MATERIALIZED (
            SELECT piece, replace(word, (SELECT pair FROM best{i}), chr({256 + i})) AS word, n FROM words{i})""")
        parts.append(f"""tok{i + 1} AS MATERIALIZED (SELECT * FROM tok{i} UNION ALL
            SELECT chr({256 + i}), (SELECT h FROM tok{i} WHERE c = substr(pair, 1, 1)) || (SELECT h FROM tok{i} WHERE c = substr(pair, 2, 1)) FROM best{i})""")
    return ", ".join(parts)


SQL["learned_merges"] = generation(
    """unicode(c) AS token_id, h AS token, false AS is_special FROM tok64
       UNION ALL SELECT 320, hex(encode('<|endoftext|>')), true""",
    merges(64),
    "FROM piece_counts",
)
SQL["byte_pair_tokens"] = generation(
    f"""doc_id, {joined("list_transform(regexp_extract_all(string_agg(word, '' ORDER BY i), '(?s).'), lambda c: unicode(c))")} AS ids
        FROM doc_pieces JOIN words64 USING (piece) GROUP BY doc_id""",
    merges(64),
    "FROM piece_counts FROM doc_pieces",
)
SQL["absent_targets"] = build(
    """SELECT t.conv_id, t.turn, t.y, CASE WHEN t.y = -1 THEN NULL ELSE coalesce(round(n.log_norm - l.logit, 6), 'inf'::DOUBLE) END AS nll
       FROM (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN list_min(ids) + 1 ELSE -1 END AS y FROM turn_coded) t
       LEFT JOIN (SELECT conv_id, turn, ln(sum(exp(logit))) AS log_norm FROM turn_logits GROUP BY ALL) n USING (conv_id, turn)
       LEFT JOIN turn_logits l ON l.conv_id = t.conv_id AND l.turn = t.turn AND l.token_id = t.y"""
)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
