"""DuckDB SQL for the registered queries, over the driver's views."""

from __future__ import annotations

WORD = r"[^ \n\t\r]+"
VOCAB_WORDS = 8192

# `round(...) + 0.0` turns DuckDB's -0.0 into the 0.0 that Spark's round gives.

# Common table expressions by name; each lists those it reads.
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ins": (
        (),
        """
        SELECT u.conv_id, u.turn, u.text AS instruction, coalesce(s.sys, '') AS input, a.text AS output
        FROM (SELECT * FROM conversations WHERE role = 'user') u
        JOIN (SELECT * FROM conversations WHERE role = 'assistant') a
          ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
        LEFT JOIN (SELECT conv_id, max(text) AS sys FROM conversations WHERE role = 'system' GROUP BY conv_id) s
          ON s.conv_id = u.conv_id""",
    ),
    "pos": (("ins",), "SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ordinal FROM ins"),
    "prm": (
        ("ins",),
        """
        SELECT *, concat('### Instruction:', chr(10), instruction, chr(10), chr(10), '### Input:', chr(10), input,
                         chr(10), chr(10), '### Response:') AS prompt
        FROM ins""",
    ),
    "sft": (("prm",), "SELECT *, concat(prompt, chr(10), output) AS text FROM prm"),
    "pairs": (
        ("prm",),
        """
        SELECT conv_id, turn, prompt, concat(prompt, ' ', output) AS chosen,
               concat(prompt, ' I don''t know, figure it out yourself.') AS rejected
        FROM prm""",
    ),
    "vals": (
        ("pairs",),
        """
        SELECT conv_id, turn, prompt, chosen AS text, CAST(1 AS DOUBLE) AS label FROM pairs
        UNION ALL
        SELECT conv_id, turn, prompt, rejected, CAST(0 AS DOUBLE) FROM pairs""",
    ),
    "vocab": (
        ("sft",),
        f"""
        SELECT tok, CAST(row_number() OVER (ORDER BY n DESC, tok) + 1 AS INTEGER) AS id
        FROM (SELECT tok, count(*) AS n
              FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS tok FROM sft)
              GROUP BY tok ORDER BY n DESC, tok LIMIT {VOCAB_WORDS})""",
    ),
    "ring": (
        ("prm",),
        """
        SELECT row_number() OVER (ORDER BY md5(concat('42:', CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR))),
                                  conv_id, turn) - 1 AS prompt_id,
               count(*) OVER () AS n, prompt, output
        FROM prm""",
    ),
    "comp": (
        ("ring",),
        """
        SELECT r.prompt_id, g.gen_id, r.prompt, concat(' ', o.output) AS completion
        FROM ring r CROSS JOIN (SELECT CAST(unnest(range(0, 4)) AS INTEGER) AS gen_id) g
        JOIN ring o ON o.prompt_id = (r.prompt_id + g.gen_id) % r.n""",
    ),
    "scored": (
        ("comp",),
        f"""
        SELECT *, CAST(0.01 AS DOUBLE) * n_words + CAST(0.1 AS DOUBLE) * n_shared AS reward,
               CAST(0.005 AS DOUBLE) * n_words + CAST(0.05 AS DOUBLE) * n_shared AS value
        FROM (SELECT *, len(regexp_extract_all(completion, '{WORD}')) AS n_words,
                     len(list_intersect(list_distinct(regexp_extract_all(prompt, '{WORD}')),
                                        list_distinct(regexp_extract_all(completion, '{WORD}')))) AS n_shared
              FROM comp)""",
    ),
}


def _ids(source: str, keys: str, text: str) -> str:
    """(keys, pos, id) of every token."""
    return f"""
        SELECT {keys}, pos, coalesce(id, 1) AS id
        FROM (SELECT {keys}, unnest(w) AS tok, generate_subscripts(w, 1) AS pos
              FROM (SELECT {keys}, regexp_extract_all({text}, '{WORD}') AS w FROM {source}))
        LEFT JOIN vocab USING (tok)"""


def _lists(source: str, keys: str, text: str) -> str:
    """(keys, ids) of every row, no tokens giving an empty list."""
    return f"""
        SELECT {keys}, list_transform(list_filter(list(struct_pack(pos := pos, id := coalesce(id, 1)) ORDER BY pos),
                                                  lambda x: x.pos > 0), lambda x: x.id) AS ids
        FROM (SELECT {keys}, tok, pos
              FROM (SELECT {keys}, unnest(w) AS tok, generate_subscripts(w, 1) AS pos
                    FROM (SELECT {keys}, regexp_extract_all({text}, '{WORD}') AS w FROM {source}))
              UNION ALL SELECT {keys}, NULL, 0 FROM {source})
        LEFT JOIN vocab USING (tok) GROUP BY {keys}"""


def _bigrams(ids: str, keys: str, first: str = "0") -> str:
    return f"""
        SELECT {keys}, coalesce(lag(id) OVER (PARTITION BY {keys} ORDER BY pos), {first}) AS prev, id AS next
        FROM {ids}"""


def _counts(bigrams: str) -> str:
    return f"SELECT prev, next, count(*) AS n FROM {bigrams} GROUP BY prev, next"


def _contexts(counts: str) -> str:
    return f"SELECT prev, CAST(sum(n) AS BIGINT) AS c FROM {counts} GROUP BY prev"


def _logprob(bigrams: str, counts: str, contexts: str, keys: str) -> str:
    """(keys, lp, n_tokens); add-0.1 smoothing over the vocabulary and its two special ids."""
    return f"""
        SELECT {keys}, count(*) AS n_tokens,
               CAST(sum(CAST(round(ln((coalesce(n, 0) + CAST(0.1 AS DOUBLE))
                                      / (coalesce(c, 0) + CAST(0.1 AS DOUBLE) * v.size)), 9)
                             AS DECIMAL(38,9))) AS DOUBLE) AS lp
        FROM {bigrams} b
        LEFT JOIN {counts} k ON k.prev = b.prev AND k.next = b.next
        LEFT JOIN {contexts} x ON x.prev = b.prev
        CROSS JOIN (SELECT count(*) + 2 AS size FROM vocab) v
        GROUP BY {keys}"""


def _query(body: str, needs: tuple[str, ...] = (), extra: dict[str, str] | None = None) -> str:
    """``body`` behind the CTEs it needs and, after them, its own."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in CTES[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in ordered]
    parts += [f"{name} AS ({sql})" for name, sql in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


KEY = "conv_id, turn"
SEQ = "prompt_id, gen_id"


def _joined(column: str) -> str:
    return f"array_to_string({column}, ',')"


def _two_models(scored: dict[str, str], keys: str) -> dict[str, str]:
    """Policy counts from the training texts, reference counts from the documents, log-probabilities of both."""
    return {
        "sft_ids": _ids("sft", KEY, "text"),
        "sft_b": _bigrams("sft_ids", KEY),
        "pol": _counts("sft_b"),
        "pol_c": _contexts("pol"),
        "doc_ids": _ids("documents", "doc_id", "text"),
        "doc_b": _bigrams("doc_ids", "doc_id"),
        "ref": _counts("doc_b"),
        "ref_c": _contexts("ref"),
        **scored,
        "pol_lp": _logprob("seq_b", "pol", "pol_c", keys),
        "ref_lp": _logprob("seq_b", "ref", "ref_c", keys),
    }


# Position of the first validation row: three quarters of the rows train.
N_TRAIN = "(SELECT round_even(count(*) * 75 / 100, 0) FROM ins)"

# The last prompt word is always 'Response:', so its id comes before every completion.
LAST_PROMPT_ID = "(SELECT coalesce(max(id), 1) FROM vocab WHERE tok = 'Response:')"

ORACLES: dict[str, str] = {
    "read_instructions": _query("SELECT * FROM ins", ("ins",)),
    "select_split": _query(
        f"SELECT {KEY}, instruction, input, output, 'validation' AS split FROM pos WHERE ordinal >= {N_TRAIN}",
        ("pos",),
    ),
    "jsonl_roundtrip": _query("SELECT * FROM pairs", ("pairs",)),
    "read_keyless": _query("SELECT instruction, input, output FROM ins", ("ins",)),
    "stream_instructions": _query("SELECT * FROM ins", ("ins",)),
    "export_ordered": _query("SELECT ordinal, instruction, input, output FROM pos", ("pos",)),
    "write_counts": _query(
        """
        SELECT sink, n * factor AS rows
        FROM (SELECT count(*) AS n FROM ins)
        CROSS JOIN (VALUES ('ppo_prompts', 1), ('grpo_items', 1), ('dpo_pairs', 1), ('reward_pairs', 1),
                           ('value_data', 2)) s(sink, factor)""",
        ("ins",),
    ),
    "to_jsonl": _query("SELECT * FROM ins", ("ins",)),
    "write_modes": _query(
        """
        SELECT mode, n * factor AS rows FROM (SELECT count(*) AS n FROM ins)
        CROSS JOIN (VALUES ('errorifexists', 1), ('append', 2), ('overwrite', 1)) m(mode, factor)""",
        ("ins",),
    ),
    "contract_report": _query(
        f"""
        SELECT rule, field, CAST(rows AS BIGINT) AS rows FROM (
          {' UNION ALL '.join(
              f"SELECT 'missing' AS rule, '{c}' AS field, 0 AS rows UNION ALL SELECT 'type', '{c}', 0 "
              f"UNION ALL SELECT 'null', '{c}', count(*) - count({c}) FROM pairs"
              for c in ("conv_id", "turn", "prompt", "chosen", "rejected"))}
          UNION ALL SELECT 'missing', 'score', count(*) FROM pairs
          {' '.join(
              f"UNION ALL SELECT 'prompt_prefix', '{c}', count(*) FILTER (NOT starts_with({c}, prompt)) FROM pairs "
              f"UNION ALL SELECT 'empty_completion', '{c}', "
              f"count(*) FILTER (len(regexp_extract_all(substr({c}, length(prompt) + 1), '{WORD}')) = 0) FROM pairs"
              for c in ("chosen", "rejected"))}
          UNION ALL SELECT 'repeated_key', 'conv_id, turn', count(*) - count(DISTINCT (conv_id, turn)) FROM pairs)""",
        ("pairs",),
    ),
    "length_report": _query(
        f"""
        SELECT field, "limit", count(*) AS rows, count(*) FILTER (n > "limit") AS over,
               CAST(max(n) AS BIGINT) AS longest, CAST(sum(n) AS BIGINT) AS tokens
        FROM ({' UNION ALL '.join(f"SELECT '{c}' AS field, len(regexp_extract_all({c}, '{WORD}')) AS n FROM sft" for c in ("instruction", "output", "text"))})
        CROSS JOIN (SELECT CAST(unnest([32, 256, 512]) AS BIGINT) AS "limit")
        GROUP BY field, "limit\"""",
        ("sft",),
    ),
    "split_overlap": _query(
        f"""
        SELECT 'key' AS by, CAST(0 AS BIGINT) AS shared, count(*) AS only FROM pos WHERE ordinal >= {N_TRAIN}
        UNION ALL
        SELECT 'text', count(*) FILTER (known), count(*) FILTER (NOT known)
        FROM (SELECT md5(output) IN (SELECT md5(output) FROM pos WHERE ordinal < {N_TRAIN}) AS known FROM pos WHERE ordinal >= {N_TRAIN})""",
        ("pos",),
    ),
    "passage_overlap": _query(
        f"""
        SELECT {KEY}, greatest(len(w) - 3, 0) AS passages, coalesce(shared, 0) AS shared
        FROM p LEFT JOIN (SELECT {KEY}, count(*) AS shared FROM g
                          WHERE ordinal >= {N_TRAIN} AND gram IN (SELECT gram FROM g WHERE ordinal < {N_TRAIN}) GROUP BY {KEY}) USING ({KEY})
        WHERE ordinal >= {N_TRAIN}""",
        ("pos",),
        {
            "p": f"SELECT {KEY}, ordinal, regexp_extract_all(output, '{WORD}') AS w FROM pos",
            "g": f"SELECT {KEY}, ordinal, array_to_string(w[i:i + 3], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - 2)) AS i FROM p)",
        },
    ),
    "with_ordinal": _query(f"SELECT {KEY}, instruction, ordinal FROM pos", ("pos",)),
    "slice_head": _query(f"SELECT {KEY}, prompt FROM prm ORDER BY {KEY} LIMIT 200", ("prm",)),
    "slice_range": _query("SELECT * EXCLUDE (ordinal) FROM pos WHERE ordinal >= 200 AND ordinal < 400", ("pos",)),
    "slice_percent": _query(
        "SELECT * EXCLUDE (ordinal) FROM pos WHERE ordinal < (SELECT round_even(count(*) * 10 / 100, 0) FROM ins)", ("pos",)
    ),
    "train_val_split": _query(
        "SELECT * EXCLUDE (ordinal), CASE WHEN ordinal < 150 THEN 'train' ELSE 'validation' END AS split FROM pos WHERE ordinal < 200",
        ("pos",),
    ),
    "format_sft": _query("SELECT * EXCLUDE (prompt) FROM sft", ("sft",)),
    "format_sft_padded": _query(
        "SELECT * EXCLUDE (prompt, text), concat(chr(10), text, chr(10)) AS text FROM sft", ("sft",)
    ),
    "build_prompt": _query(f"SELECT {KEY}, prompt FROM prm", ("prm",)),
    "build_infer_prompt": _query(f"SELECT {KEY}, concat(prompt, chr(10)) AS prompt FROM prm", ("prm",)),
    "chat_prompt": """
        SELECT conv_id, concat(string_agg(concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)), '' ORDER BY turn),
                               '<|im_start|>assistant', chr(10)) AS prompt
        FROM conversations GROUP BY conv_id""",
    "dpo_pairs": _query(
        f"""
        SELECT {KEY}, prompt, ' This response is more helpful and complete.' AS chosen,
               ' This response is shorter and less detailed.' AS rejected
        FROM prm""",
        ("prm",),
    ),
    "reward_pairs": _query("SELECT * FROM pairs", ("pairs",)),
    "value_examples": _query(f"SELECT {KEY}, text, label FROM vals", ("vals",)),
    "pairs_best_worst": """
        SELECT p.lang, p.source, chosen_id, rejected_id, c.text AS chosen, r.text AS rejected
        FROM (SELECT lang, source, min(doc_id) FILTER (quality = best) AS chosen_id, min(doc_id) FILTER (quality = worst) AS rejected_id
              FROM (SELECT doc_id, lang, source, quality, max(quality) OVER w AS best, min(quality) OVER w AS worst
                    FROM documents JOIN labels USING (doc_id) WINDOW w AS (PARTITION BY lang, source))
              WHERE best > worst GROUP BY lang, source) p
        JOIN documents c ON c.doc_id = chosen_id JOIN documents r ON r.doc_id = rejected_id""",
    "pairs_all": """
        WITH r AS (
          SELECT doc_id, lang, source, quality, concat('{"lang":"', lang, '","source":"', source, '"}') AS label,
                 row_number() OVER (PARTITION BY lang, source ORDER BY quality, doc_id) - 1 AS place,
                 rank() OVER (PARTITION BY lang, source ORDER BY quality) - 1 AS worse
          FROM documents JOIN labels USING (doc_id)),
        n AS (
          SELECT *, coalesce(sum(worse) OVER (PARTITION BY lang, source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first,
                 sum(worse) OVER (PARTITION BY lang, source) AS total
          FROM r),
        d AS (
          SELECT g.*, j, j * total // least(total, 4) AS low, (j + 1) * total // least(total, 4) AS high,
                 ('0x' || substr(md5(concat('42:', label, ':', CAST(j AS VARCHAR))), 1, 15))::bigint AS lot
          FROM (SELECT DISTINCT lang, source, label, total FROM n) g, range(0, 4) t(j) WHERE j < total)
        SELECT b.lang, b.source, b.doc_id AS chosen_id, w.doc_id AS rejected_id, c.text AS chosen, t.text AS rejected
        FROM d JOIN n b ON b.label = d.label AND d.low + d.lot % (d.high - d.low) >= b.first AND d.low + d.lot % (d.high - d.low) < b.first + b.worse
        JOIN n w ON w.label = d.label AND w.place = d.low + d.lot % (d.high - d.low) - b.first
        JOIN documents c ON c.doc_id = b.doc_id JOIN documents t ON t.doc_id = w.doc_id""",
    "contract_violations": f"""
        WITH r AS (SELECT doc_id, md5(text) AS digest, text, source, quality FROM documents LEFT JOIN labels USING (doc_id))
        SELECT digest, 'null' AS rule, 'quality' AS field, count(*) AS rows FROM r WHERE quality IS NULL GROUP BY digest
        UNION ALL SELECT digest, 'null', 'text', count(*) FROM r WHERE text IS NULL GROUP BY digest
        UNION ALL SELECT digest, 'prompt_prefix', 'text', count(*) FROM r WHERE NOT starts_with(coalesce(text, ''), source) GROUP BY digest
        UNION ALL SELECT digest, 'empty_completion', 'text', count(*) FROM r
          WHERE len(regexp_extract_all(CASE WHEN starts_with(coalesce(text, ''), source) THEN substr(text, length(source) + 1) ELSE coalesce(text, '') END, '{WORD}')) = 0
          GROUP BY digest
        UNION ALL SELECT digest, 'repeated_key', 'digest', count(*) FROM r GROUP BY digest HAVING count(*) > 1""",
    "group_report": """
        SELECT source, rows, n AS of FROM (SELECT source, count(*) AS rows FROM documents GROUP BY source)
        CROSS JOIN (SELECT count(*) AS n FROM documents) WHERE rows >= CAST(0.03 AS DOUBLE) * n""",
    "length_percentiles": _query(
        f"""
        SELECT field, CAST(percent AS INTEGER) AS percent, CAST(quantile_disc AS BIGINT) AS length
        FROM ({' UNION ALL '.join(
            f"SELECT '{c}' AS field, {p} AS percent, quantile_disc(len(regexp_extract_all({c}, '{WORD}')), {p / 100}) AS quantile_disc FROM sft"
            for c in ("instruction", "output", "text") for p in (50, 90, 99, 100))})""",
        ("sft",),
    ),
    "fit_vocab": _query("SELECT tok, id FROM vocab", ("vocab",)),
    "tokenize": _query(
        f"SELECT doc_id, {_joined('ids')} AS input_ids, CAST(len(ids) AS INTEGER) AS n_tokens FROM t",
        ("vocab",),
        {"t": _lists("documents", "doc_id", "text")},
    ),
    "detokenize": _query(
        """
        SELECT doc_id, coalesce(text, '') AS text FROM documents_only
        LEFT JOIN (SELECT doc_id, string_agg(tok, ' ' ORDER BY pos) AS text
                   FROM t JOIN vocab USING (id) GROUP BY doc_id) USING (doc_id)""",
        ("vocab",),
        {"t": _ids("documents", "doc_id", "text"), "documents_only": "SELECT doc_id FROM documents"},
    ),
    "ppo_tokens": _query(
        f"SELECT {KEY}, {_joined('ids')} AS input_ids FROM t", ("vocab",), {"t": _lists("prm", KEY, "prompt")}
    ),
    "value_tokens": _query(
        f"""
        SELECT {KEY}, label AS labels, {_joined('ids[1:256]')} AS input_ids,
               {_joined('list_transform(ids[1:256], lambda x: 1)')} AS attention_mask
        FROM t""",
        ("vocab", "vals"),
        {"t": _lists("vals", f"{KEY}, label", "text")},
    ),
    "truncate_256": _query(
        f"SELECT doc_id, {_joined('ids[1:256]')} AS input_ids, CAST(len(ids[1:256]) AS INTEGER) AS n_tokens FROM t",
        ("vocab",),
        {"t": _lists("documents", "doc_id", "text")},
    ),
    "epoch_batches": _query(
        f"""
        SELECT {KEY}, epoch, place // 4 AS batch_id, CAST(place % 4 AS INTEGER) AS slot
        FROM (SELECT {KEY}, epoch, row_number() OVER (PARTITION BY epoch ORDER BY
                       md5(concat('42:', CAST(epoch AS VARCHAR), ':', CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR))),
                       {KEY}) - 1 AS place
              FROM ins CROSS JOIN (SELECT CAST(unnest(range(0, 3)) AS INTEGER) AS epoch))""",
        ("ins",),
    ),
    "pad_batches": _query(
        f"""
        SELECT {KEY}, batch_id, {_joined('list_resize(ids, m, 0)')} AS input_ids,
               {_joined('list_resize(list_transform(ids, lambda x: 1), m, 0)')} AS attention_mask
        FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS m FROM b)""",
        ("vocab",),
        {
            "t": _lists("prm", KEY, "prompt"),
            "b": f"""
            SELECT {KEY}, ids, (row_number() OVER (ORDER BY
                       md5(concat('42:0:', CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR))), {KEY}) - 1) // 4 AS batch_id
            FROM t""",
        },
    ),
    "pad_own_token": _query(
        f"""
        SELECT {KEY}, batch_id, {_joined('list_resize(ids, m, 2)')} AS input_ids,
               {_joined('list_resize(list_transform(ids, lambda x: 1), m, 0)')} AS attention_mask
        FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS m FROM b)""",
        ("vocab",),
        {
            "t": _lists("prm", KEY, "prompt"),
            "b": f"""
            SELECT {KEY}, list_transform(ids, lambda x: CASE WHEN x > 1 THEN x + 1 ELSE x END) AS ids, (row_number() OVER (ORDER BY
                       md5(concat('42:0:', CAST(conv_id AS VARCHAR), ':', CAST(turn AS VARCHAR))), {KEY}) - 1) // 4 AS batch_id
            FROM t""",
        },
    ),
    "fan_out": _query(
        f"SELECT {KEY}, prompt, gen_id FROM prm CROSS JOIN (SELECT CAST(unnest(range(0, 4)) AS INTEGER) AS gen_id)",
        ("prm",),
    ),
    "completion_text": _query(
        "SELECT prompt_id, gen_id, prompt, completion, concat(prompt, completion) AS text FROM comp", ("comp",)
    ),
    "score_inputs": _query(
        f"""
        SELECT {SEQ}, {_joined('list_resize(ids, m, 0)')} AS input_ids,
               {_joined('list_resize(list_transform(ids, lambda x: 1), m, 0)')} AS attention_mask
        FROM (SELECT {SEQ}, ids[1:512] AS ids, max(len(ids[1:512])) OVER (PARTITION BY prompt_id) AS m FROM t)""",
        ("vocab", "comp"),
        {"texts": f"SELECT {SEQ}, concat(prompt, completion) AS text FROM comp", "t": _lists("texts", SEQ, "text")},
    ),
    "strip_prompt": _query(
        f"""
        SELECT {KEY}, response, {_joined('ids')} AS response_ids
        FROM t JOIN (SELECT {KEY}, concat(' ', output) AS response FROM prm) USING ({KEY})""",
        ("vocab", "prm"),
        {"t": _lists("prm", KEY, "output")},
    ),
    "reward_callback": _query(
        "SELECT prompt_id, gen_id, CAST(length(prompt) + 2 * length(completion) AS DOUBLE) AS reward FROM comp", ("comp",)
    ),
    "group_advantage": _query(
        """
        SELECT prompt_id, gen_id, round(reward, 6) AS reward,
               round((reward - avg(reward) OVER (PARTITION BY prompt_id))
                     / (coalesce(stddev_samp(reward) OVER (PARTITION BY prompt_id), 0) + CAST(0.0001 AS DOUBLE)), 6) + 0.0 AS advantage
        FROM scored""",
        ("scored",),
    ),
    "value_advantage": _query(
        """
        SELECT prompt_id, gen_id, round(reward, 6) AS reward, round(value, 6) AS value,
               round(reward - value, 6) + 0.0 AS advantage
        FROM scored""",
        ("scored",),
    ),
    "kl_reward": _query(
        f"""
        SELECT {SEQ}, n_tokens, round(reward, 5) AS reward, round(p.lp - r.lp, 5) + 0.0 AS kl,
               round(reward - CAST(0.05 AS DOUBLE) * (p.lp - r.lp), 5) + 0.0 AS kl_reward
        FROM scored JOIN pol_lp p USING ({SEQ}) JOIN (SELECT {SEQ}, lp FROM ref_lp) r USING ({SEQ})""",
        ("sft", "vocab", "scored"),
        _two_models(
            {"seq_ids": _ids("comp", SEQ, "completion"), "seq_b": _bigrams("seq_ids", SEQ, LAST_PROMPT_ID)}, SEQ
        ),
    ),
    "token_returns": _query(
        f"""
        SELECT {SEQ}, CAST(pos - 1 AS INTEGER) AS pos, round(kl, 4) + 0.0 AS kl, round(paid, 4) + 0.0 AS token_reward,
               round(sum(paid) OVER (PARTITION BY {SEQ} ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) + 0.0 AS token_return
        FROM (SELECT {SEQ}, pos, kl, CAST(-0.05 AS DOUBLE) * kl + CASE WHEN pos = max(pos) OVER (PARTITION BY {SEQ}) THEN reward ELSE 0 END AS paid
              FROM (SELECT p.prompt_id, p.gen_id, p.pos, p.lp - r.lp AS kl FROM pol_t p JOIN ref_t r USING ({SEQ}, pos)) JOIN scored USING ({SEQ}))""",
        ("sft", "vocab", "scored"),
        {
            **_two_models({"seq_ids": _ids("comp", SEQ, "completion"), "seq_b": _bigrams("seq_ids", SEQ, LAST_PROMPT_ID)}, SEQ),
            "seq_p": f"SELECT {SEQ}, pos, coalesce(lag(id) OVER (PARTITION BY {SEQ} ORDER BY pos), {LAST_PROMPT_ID}) AS prev, id AS next FROM seq_ids",
            **{
                f"{model}_t": f"""
                SELECT {SEQ}, pos, round(ln((coalesce(n, 0) + CAST(0.1 AS DOUBLE)) / (coalesce(c, 0) + CAST(0.1 AS DOUBLE) * v.size)), 9) AS lp
                FROM seq_p b LEFT JOIN {model} k ON k.prev = b.prev AND k.next = b.next LEFT JOIN {model}_c x ON x.prev = b.prev
                CROSS JOIN (SELECT count(*) + 2 AS size FROM vocab) v"""
                for model in ("pol", "ref")
            },
        },
    ),
    "bigram_fit": _query(
        "SELECT prev, next, n FROM bi",
        ("vocab",),
        {"t": _ids("documents", "doc_id", "text"), "b": _bigrams("t", "doc_id"), "bi": _counts("b")},
    ),
    "seq_logprob": _query(
        """
        SELECT doc_id, round(coalesce(lp, 0), 5) AS logprob, coalesce(n_tokens, 0) AS n_tokens
        FROM (SELECT doc_id FROM documents) LEFT JOIN lp USING (doc_id)""",
        ("sft", "vocab"),
        {
            "sft_ids": _ids("sft", KEY, "text"),
            "sft_b": _bigrams("sft_ids", KEY),
            "pol": _counts("sft_b"),
            "pol_c": _contexts("pol"),
            "doc_ids": _ids("documents", "doc_id", "text"),
            "doc_b": _bigrams("doc_ids", "doc_id"),
            "lp": _logprob("doc_b", "pol", "pol_c", "doc_id"),
        },
    ),
    "lm_eval": _query(
        """
        SELECT sequences, tokens, round(-total / tokens, 6) AS nll, round(exp(-total / tokens), 2) AS perplexity
        FROM (SELECT count(*) AS sequences, CAST(sum(n_tokens) AS BIGINT) AS tokens,
                     CAST(sum(CAST(lp AS DECIMAL(38,9))) AS DOUBLE) AS total FROM lp)""",
        ("pos", "sft"),
        {
            "part": f"SELECT sft.conv_id, sft.turn, text, ordinal FROM sft JOIN pos USING ({KEY})",
            "train": f"SELECT * FROM part WHERE ordinal < {N_TRAIN}",
            "held": f"SELECT * FROM part WHERE ordinal >= {N_TRAIN}",
            "vocab": CTES["vocab"][1].replace("FROM sft", "FROM train"),
            "train_ids": _ids("train", KEY, "text"),
            "train_b": _bigrams("train_ids", KEY),
            "bi": _counts("train_b"),
            "cx": _contexts("bi"),
            "held_ids": _ids("held", KEY, "text"),
            "held_b": _bigrams("held_ids", KEY),
            "lp": _logprob("held_b", "bi", "cx", KEY),
        },
    ),
    "dpo_metrics": _query(
        """
        SELECT count(*) AS pairs, round(avg(ln(1 + exp(-margin))), 6) AS loss, round(avg(margin), 6) AS margin,
               round(avg(CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM (SELECT conv_id, turn, CAST(0.1 AS DOUBLE) * sum(CASE WHEN side = 'chosen' THEN d ELSE -d END) AS margin
              FROM (SELECT p.conv_id, p.turn, p.side, p.lp - r.lp AS d
                    FROM pol_lp p JOIN ref_lp r ON r.conv_id = p.conv_id AND r.turn = p.turn AND r.side = p.side)
              GROUP BY conv_id, turn)""",
        ("sft", "vocab"),
        _two_models(
            {
                "sides": f"""
                SELECT {KEY}, 'chosen' AS side, concat(' ', output) AS completion FROM prm
                UNION ALL
                SELECT {KEY}, 'rejected', ' I don''t know, figure it out yourself.' FROM prm""",
                "seq_ids": _ids("sides", f"{KEY}, side", "completion"),
                "seq_b": _bigrams("seq_ids", f"{KEY}, side", LAST_PROMPT_ID),
            },
            f"{KEY}, side",
        ),
    ),
    "preference_metrics": _query(
        """
        SELECT count(*) AS pairs, round(avg(CASE WHEN c > r THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               round(avg(c - r), 6) AS margin
        FROM (SELECT CAST(0.01 AS DOUBLE) * len(cw) + CAST(0.1 AS DOUBLE) * len(list_intersect(list_distinct(pw), list_distinct(cw))) AS c,
                     CAST(0.01 AS DOUBLE) * len(rw) + CAST(0.1 AS DOUBLE) * len(list_intersect(list_distinct(pw), list_distinct(rw))) AS r
              FROM w)""",
        ("prm",),
        {
            "w": f"""
            SELECT regexp_extract_all(prompt, '{WORD}') AS pw, regexp_extract_all(output, '{WORD}') AS cw,
                   regexp_extract_all('I don''t know, figure it out yourself.', '{WORD}') AS rw
            FROM prm"""
        },
    ),
    "metric_intervals": _query(
        """
        SELECT e.metric, rows, round(estimate, 6) AS estimate, round(low, 6) AS low, round(high, 6) AS high
        FROM (SELECT metric, count(*) AS rows, avg(v) AS estimate FROM m GROUP BY metric) e
        JOIN (SELECT metric, max(CASE WHEN place = 2 THEN v END) AS low, max(CASE WHEN place = 38 THEN v END) AS high FROM ranked GROUP BY metric) i
          ON i.metric = e.metric""",
        ("prm",),
        {
            "w": f"""
            SELECT conv_id, turn, regexp_extract_all(prompt, '{WORD}') AS pw, regexp_extract_all(output, '{WORD}') AS cw,
                   regexp_extract_all('I don''t know, figure it out yourself.', '{WORD}') AS rw
            FROM prm""",
            "s": """
            SELECT conv_id, turn,
                   (CAST(0.01 AS DOUBLE) * len(cw) + CAST(0.1 AS DOUBLE) * len(list_intersect(list_distinct(pw), list_distinct(cw))))
                   - (CAST(0.01 AS DOUBLE) * len(rw) + CAST(0.1 AS DOUBLE) * len(list_intersect(list_distinct(pw), list_distinct(rw)))) AS d
            FROM w""",
            "m": """
            SELECT conv_id, turn, 'margin' AS metric, d AS v FROM s
            UNION ALL SELECT conv_id, turn, 'accuracy', CASE WHEN d > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END FROM s""",
            # Weights of mean 1: how many of a Poisson count's steps a number of 16 bits has passed.
            "weighed": """
            SELECT metric, v, b * 8 + i AS replicate, (u >= 24109)::INT + (u >= 48218)::INT + (u >= 60273)::INT + (u >= 64291)::INT
                   + (u >= 65296)::INT + (u >= 65497)::INT + (u >= 65530)::INT AS k
            FROM (SELECT metric, v, b, i, ('0x' || substr(md5(concat('42:', conv_id, ':', turn, ':', b)), 4 * i + 1, 4))::INT AS u
                  FROM m, range(0, 5) t(b), range(0, 8) r(i))""",
            "ranked": """
            SELECT metric, v, row_number() OVER (PARTITION BY metric ORDER BY v, replicate) AS place
            FROM (SELECT metric, replicate, sum(k * v) / sum(k) AS v FROM weighed GROUP BY metric, replicate)""",
        },
    ),
    "value_metrics": _query(
        """
        SELECT count(*) AS rows, round(avg((v - label) * (v - label)), 6) AS mse
        FROM (SELECT label, CAST(0.005 AS DOUBLE) * len(rw)
                            + CAST(0.05 AS DOUBLE) * len(list_intersect(list_distinct(pw), list_distinct(rw))) AS v
              FROM w)""",
        ("vals",),
        {
            "w": f"""
            SELECT label, regexp_extract_all(prompt, '{WORD}') AS pw,
                   regexp_extract_all(substr(text, length(prompt) + 1), '{WORD}') AS rw
            FROM vals"""
        },
    ),
    # Facts that hold of any fit, so that SQL need not fit.
    "model_roundtrip": _query(
        f"SELECT {SEQ}, CAST(0 AS DOUBLE) AS reward_difference, CAST(0 AS DOUBLE) AS logprob_difference FROM comp", ("comp",)
    ),
    "model_facts": _query(
        """
        SELECT fact, n * factor AS rows, CAST(0 AS DOUBLE) AS error FROM (SELECT count(*) AS n FROM ins)
        CROSS JOIN (VALUES ('reward of nothing', 1), ('mean value less mean label', 2), ('slope of the reward loss', 2),
                           ('slope of the value loss', 2), ('accuracy short of its floor', 1)) f(fact, factor)""",
        ("ins",),
    ),
    "grpo_scores": _query(
        "SELECT prompt_id, count(*) AS n, CAST(0 AS DOUBLE) AS mean_advantage FROM comp GROUP BY prompt_id", ("comp",)
    ),
    "ppo_scores": _query(
        f"SELECT {SEQ}, round(p.lp - r.lp, 5) + 0.0 AS kl, CAST(0 AS DOUBLE) AS gap FROM pol_lp p JOIN (SELECT {SEQ}, lp FROM ref_lp) r USING ({SEQ})",
        ("sft", "vocab", "comp"),
        _two_models({"seq_ids": _ids("comp", SEQ, "completion"), "seq_b": _bigrams("seq_ids", SEQ, LAST_PROMPT_ID)}, SEQ),
    ),
}
