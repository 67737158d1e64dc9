"""DuckDB SQL that recomputes each registered query independently.

DuckDB's RE2 has no lookahead, so the pretokenizer is rewritten: the last
whitespace character before a non-space is split off with a private-use
marker (U+E000, absent from the inputs), then the pattern without the
lookahead alternative is applied.
"""

from __future__ import annotations

# RE2 forms of the whitespace classes (same code points as tokenmill.constants).
WS_STRIP = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
_WSP = r"\t-\r \x{85}\p{Z}"
MARK = "\ue000"  # private-use marker, absent from the inputs


def strip_sql(col: str) -> str:
    return rf"regexp_replace({col}, '\A{WS_STRIP}+|{WS_STRIP}+\z', '', 'g')"


def norm_sql(col: str) -> str:
    return rf"regexp_replace({strip_sql(col)}, '{WS_STRIP}+', ' ', 'g')"


def fp_sql(col: str) -> str:
    return f"sha256({norm_sql(col)})"


def pretok_sql(col: str) -> str:
    marked = rf"regexp_replace({col}, '([{_WSP}]+)([{_WSP}])([^{_WSP}])', '\1{MARK}\2\3', 'g')"
    pat = (
        r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
        rf"| ?[^{_WSP}\p{{L}}\p{{N}}\x{{E000}}]+|[{_WSP}]+"
    )
    return f"regexp_extract_all({marked}, '{pat}')"


def bytes_list_sql(col: str) -> str:
    """UTF-8 bytes of a string as a DuckDB list of ints."""
    return f"list_transform(regexp_extract_all(hex(encode({col})), '..'), lambda h: ('0x' || h)::INTEGER)"


CLEAN_DOCS = f"(SELECT doc_id, {strip_sql("coalesce(text, '')")} AS text FROM documents)"
CLEAN_DOCS_F = f"(SELECT * FROM {CLEAN_DOCS} c WHERE length(c.text) > 0)"

TOKS = f"""(SELECT doc_id, unnest(t) AS pretoken, generate_subscripts(t, 1) - 1 AS pos
  FROM (SELECT doc_id, {pretok_sql('text')} AS t FROM {CLEAN_DOCS_F}))"""

WORD_FREQ = f"""(SELECT pretoken, count(*)::BIGINT AS freq,
    min({{'d': doc_id, 'p': pos}}) AS first FROM {TOKS} GROUP BY pretoken)"""

PAIRS = f"""(SELECT pretoken, freq, first, a, b, min(i) AS idx FROM (
   SELECT pretoken, freq, first, ids[i] AS a, ids[i+1] AS b, i
   FROM (SELECT pretoken, freq, first, {bytes_list_sql('pretoken')} AS ids FROM {WORD_FREQ}) w,
        LATERAL (SELECT unnest(range(1, len(w.ids))) AS i)
 ) GROUP BY ALL)"""

PAIR_STATS = f"""(SELECT a, b, sum(freq)::BIGINT AS cnt,
    min({{'d': first.d, 'p': first.p, 'i': idx}}) AS first FROM {PAIRS} GROUP BY a, b)"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["read_documents"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
    q["clean_documents"] = f"SELECT doc_id, text FROM {CLEAN_DOCS_F}"
    q["normalize_text"] = f"SELECT doc_id, {norm_sql('text')} AS norm_text FROM {CLEAN_DOCS_F}"
    q["doc_fingerprint"] = f"SELECT doc_id, {fp_sql('text')} AS fp FROM {CLEAN_DOCS_F}"
    q["dedupe_exact"] = f"""SELECT min_by(doc_id, doc_id) AS doc_id, min_by(text, doc_id) AS text, fp
        FROM (SELECT doc_id, text, {fp_sql('text')} AS fp FROM {CLEAN_DOCS_F}) GROUP BY fp"""
    q["dedupe_report"] = f"""SELECT count(*)::BIGINT AS docs_read, count(DISTINCT fp)::BIGINT AS unique_kept,
        (count(*) - count(DISTINCT fp))::BIGINT AS duplicates_dropped
        FROM (SELECT {fp_sql('text')} AS fp FROM {CLEAN_DOCS_F})"""
    q["ingest_report"] = f"""WITH r AS (SELECT doc_id, text AS t FROM {CLEAN_DOCS}),
        k AS (SELECT min_by(octet_length(encode(t)), doc_id) AS b FROM r WHERE length(t) > 0 GROUP BY {fp_sql('t')})
        SELECT (SELECT count(*) FROM r)::BIGINT AS rows_read,
               (SELECT count(*) FROM r WHERE length(t) > 0)::BIGINT AS non_empty,
               (SELECT count(*) FROM r WHERE length(t) = 0)::BIGINT AS blank,
               ((SELECT count(*) FROM r WHERE length(t) > 0) - (SELECT count(*) FROM k))::BIGINT AS duplicates,
               (SELECT coalesce(sum(b + 17), 0) FROM k)::BIGINT AS output_bytes"""
    q["skip_rows"] = "SELECT doc_id, text FROM documents ORDER BY doc_id OFFSET 100"
    q["pretokenize"] = f"SELECT doc_id, pos::BIGINT AS pos, pretoken FROM {TOKS}"
    q["pretoken_counts"] = f"""SELECT pretoken, freq, first.d AS first_doc, first.p::BIGINT AS first_pos
        FROM {WORD_FREQ}"""
    q["pretoken_bytes"] = f"""SELECT pretoken, array_to_string({bytes_list_sql('pretoken')}, ' ') AS ids
        FROM (SELECT DISTINCT pretoken FROM {TOKS})"""
    q["adjacent_pairs"] = f"""SELECT pretoken, string_agg(a || ',' || b, ' ' ORDER BY idx) AS pairs
        FROM {PAIRS} GROUP BY pretoken"""
    q["pair_stats"] = f"SELECT a, b, cnt FROM {PAIR_STATS}"
    q["top_pair"] = f"""SELECT row_number() OVER (ORDER BY cnt DESC, first)::BIGINT AS rank, a, b, cnt
        FROM {PAIR_STATS} ORDER BY cnt DESC, first LIMIT 20"""
    q["corpus_token_stats"] = f"""SELECT count(*)::BIGINT AS docs, sum(octet_length(encode(text)))::BIGINT AS bytes,
        sum(len({pretok_sql('text')}))::BIGINT AS pretokens FROM {CLEAN_DOCS_F}"""
    q.update(bpe_sql())
    q.update(codec_sql())
    q.update(windows_sql())
    q.update(scores_sql())
    q.update(more_sql())
    q.update(io_sql())
    q.update(stream_sql())
    return q


def _bpe_ctes(k: int) -> str:
    """Unrolled one-at-a-time BPE training for ``k`` rounds.

    A word is written ``<97><98>``; merging is ``replace`` of ``<a><b>``.
    """
    ctes = [
        f"""w0 AS MATERIALIZED (SELECT '<' || array_to_string({bytes_list_sql('pretoken')}, '><') || '>' AS w,
               freq, first FROM {WORD_FREQ})"""
    ]
    for r in range(k):
        ctes.append(
            f"""s{r} AS MATERIALIZED (SELECT a, b, sum(freq) AS cnt, min({{'d': first.d, 'p': first.p, 'i': i}}) AS f
          FROM (SELECT a, b, freq, first, min(i) AS i FROM (
                  SELECT ids[i] AS a, ids[i + 1] AS b, i, freq, first
                  FROM (SELECT list_transform(string_split(w[2:-2], '><'), lambda x: x::INTEGER) AS ids, freq, first
                        FROM w{r}) t, LATERAL (SELECT unnest(range(1, len(t.ids))) AS i))
                GROUP BY a, b, freq, first)
          GROUP BY a, b)"""
        )
        ctes.append(f"m{r} AS MATERIALIZED (SELECT a, b FROM s{r} ORDER BY cnt DESC, f LIMIT 1)")
        ctes.append(
            f"""w{r + 1} AS MATERIALIZED (SELECT replace(w, '<' || m.a || '><' || m.b || '>', '<{256 + r}>') AS w,
               freq, first FROM w{r}, m{r} m)"""
        )
    return "WITH " + ",\n".join(ctes)


BPE_K = 8


def bpe_sql() -> dict[str, str]:
    k = BPE_K
    ctes = _bpe_ctes(k)
    merges = " UNION ALL ".join(
        f"SELECT {r}::BIGINT AS rank, a::BIGINT AS a, b::BIGINT AS b, {256 + r}::BIGINT AS new_id FROM m{r}"
        for r in range(k)
    )
    vocab_parts = ["v0 AS MATERIALIZED (SELECT range AS id, printf('%02X', range) AS hex FROM range(256))"]
    for r in range(k):
        vocab_parts.append(
            f"""v{r + 1} AS MATERIALIZED (SELECT id, hex FROM v{r} UNION ALL
                SELECT {256 + r}, (SELECT hex FROM v{r} WHERE id = m.a) || (SELECT hex FROM v{r} WHERE id = m.b)
                FROM m{r} m)"""
        )
    vocab_ctes = ctes + ",\n" + ",\n".join(vocab_parts)
    eot_id = 256 + k
    return {
        "bpe_train": f"{ctes}\n{merges}",
        "merge_word": f"""{ctes}
            SELECT pretoken, replace(w[2:-2], '><', ' ') AS ids FROM (
              SELECT pretoken, replace('<' || array_to_string({bytes_list_sql('pretoken')}, '><') || '>',
                                        '<' || m.a || '><' || m.b || '>', '<256>') AS w
              FROM {WORD_FREQ}, m0 m)""",
        "bpe_vocab": f"""{vocab_ctes}
            SELECT id::BIGINT AS token_id, hex FROM v{k}
            UNION ALL SELECT {eot_id}::BIGINT, hex('<|endoftext|>')""",
    }


# Same literal merge list as the codec queries (fixed values).
FIXED_MERGES = [(32, 116), (104, 101), (256, 257), (105, 110), (101, 114),
                (32, 97), (111, 110), (259, 103), (101, 110), (32, 115)]
FIXED_EOT = 256 + len(FIXED_MERGES)
EOT = "<|endoftext|>"


def enc_piece_sql(p: str) -> str:
    s = f"('<' || array_to_string({bytes_list_sql(p)}, '><') || '>')"
    for r, (a, b) in enumerate(FIXED_MERGES):
        s = f"replace({s}, '<{a}><{b}>', '<{256 + r}>')"
    return s


def enc_text_sql(t: str) -> str:
    """Encoded ``<id>`` string of a text (pretokenized, merges in rank order)."""
    return f"array_to_string(list_transform({pretok_sql(t)}, lambda p: {enc_piece_sql('p')}), '')"


def ids_str_sql(s: str) -> str:
    return f"replace(({s})[2:-2], '><', ' ')"


def n_ids_sql(s: str) -> str:
    return f"(length({s}) - length(replace({s}, '<', '')))"


EOT_DOCS = f"(SELECT doc_id, replace(text, chr(10), '{EOT}') AS text FROM {CLEAN_DOCS_F})"


def codec_sql() -> dict[str, str]:
    enc_docs = f"(SELECT doc_id, {enc_text_sql('text')} AS e FROM {CLEAN_DOCS_F})"
    parts = f"""(SELECT doc_id, unnest(string_split(text, '{EOT}')) AS part,
                 generate_subscripts(string_split(text, '{EOT}'), 1) AS seg FROM {EOT_DOCS})"""
    corpus = f"""(SELECT doc_id, string_agg({enc_text_sql(strip_sql('part'))} || '<{FIXED_EOT}>', '' ORDER BY seg) AS e
                 FROM {parts} GROUP BY doc_id)"""
    return {
        "encode_pretokens": f"""SELECT pretoken, {ids_str_sql(enc_piece_sql('pretoken'))} AS ids
            FROM (SELECT DISTINCT pretoken FROM {TOKS})""",
        "encode_documents": f"""SELECT doc_id, {n_ids_sql('e')}::BIGINT AS n_tokens, {ids_str_sql('e')} AS ids
            FROM {enc_docs}""",
        "split_on_eot": f"""SELECT doc_id, (seg - 1)::BIGINT AS seg, t AS text FROM (
            SELECT doc_id, seg, {strip_sql('part')} AS t FROM {parts}) WHERE length(t) > 0""",
        "encode_corpus": f"""SELECT doc_id, {n_ids_sql('e')}::BIGINT AS n_tokens, {ids_str_sql('e')} AS ids
            FROM {corpus}""",
        "decode_tokens": f"SELECT doc_id, text FROM {CLEAN_DOCS_F}",
        "strip_trailing_eot": f"""SELECT c.doc_id, CASE WHEN d.lang = 'en'
                 THEN regexp_replace(c.text, '{WS_STRIP}+\\z', '') ELSE c.text END AS text
            FROM {CLEAN_DOCS_F} c JOIN documents d USING (doc_id)""",
        "check_token_width": f"""SELECT max(list_max(list_transform(string_split({ids_str_sql('e')}, ' '),
                 lambda x: x::BIGINT)))::BIGINT AS max_id, 'uint16' AS width FROM {enc_docs}""",
        "utf8_decode": f"""SELECT doc_id, text || 'ok' || chr(65533) || chr(65533) || ' z' AS replaced,
                 text || 'ok z' AS ignored FROM {CLEAN_DOCS_F}""",
    }


# ---- token stream (raw bytes + EOT id 256 after every document) ----
CONV_CLEAN = f"""(SELECT conv_id, turn, t AS text FROM (
    SELECT conv_id, turn, {strip_sql("coalesce(text, '')")} AS t FROM conversations) WHERE length(t) > 0)"""


def _stream_ctes(src: str, keys: str, T: int, n_samples: str, seed: int, prefix: str) -> str:
    """CTEs ``{prefix}offs``, ``{prefix}pre`` (exclusive prefix sums), ``{prefix}win``."""
    return f"""
    {prefix}docs AS MATERIALIZED (SELECT {keys}, list_concat({bytes_list_sql('text')}, [256]) AS ids FROM {src}),
    {prefix}offs AS MATERIALIZED (SELECT {keys}, len(ids)::BIGINT AS n_tokens,
        (sum(len(ids)) OVER (ORDER BY {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - len(ids))::BIGINT AS start
        FROM {prefix}docs),
    {prefix}tok AS MATERIALIZED (SELECT o.start + i - 1 AS pos, id::BIGINT AS id FROM
        (SELECT {keys}, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM {prefix}docs) d
        JOIN {prefix}offs o USING ({keys})),
    {prefix}pre AS MATERIALIZED (SELECT pos,
        coalesce(sum(id) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS P,
        coalesce(sum(pos * id) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS Q
        FROM {prefix}tok),
    {prefix}n AS MATERIALIZED (SELECT (sum(n_tokens) - {T} - 1)::BIGINT AS max_start FROM {prefix}offs),
    {prefix}win AS MATERIALIZED (SELECT range AS sample_id,
        ('0x' || substr(md5('{seed}:' || range), 1, 15))::BIGINT % (SELECT max_start FROM {prefix}n) AS start
        FROM range({n_samples})),
    {prefix}ex AS MATERIALIZED (SELECT w.sample_id, w.start,
        (b.P - a.P)::BIGINT AS x_sum,
        ((b.Q - a.Q) - (w.start - 1) * (b.P - a.P))::BIGINT AS x_wsum,
        ((d.Q - c.Q) - w.start * (d.P - c.P))::BIGINT AS y_wsum
        FROM {prefix}win w
        JOIN {prefix}pre a ON a.pos = w.start JOIN {prefix}pre b ON b.pos = w.start + {T}
        JOIN {prefix}pre c ON c.pos = w.start + 1 JOIN {prefix}pre d ON d.pos = w.start + {T} + 1)"""


def windows_sql() -> dict[str, str]:
    T, BATCH = 32, 32
    full = "(SELECT max_start FROM n)"
    base = "WITH " + _stream_ctes(CLEAN_DOCS_F, "doc_id", T, full, 42, "").lstrip().lstrip(",")
    few = "WITH " + _stream_ctes(CLEAN_DOCS_F, "doc_id", T, "20", 42, "").lstrip().lstrip(",")
    offs_only = "WITH " + base[5:].split("tok AS MATERIALIZED")[0].rstrip().rstrip(",")
    tr = _stream_ctes(CLEAN_DOCS_F, "doc_id", T, "160000", 42, "t_")
    va = _stream_ctes(CONV_CLEAN, "conv_id, turn", T, "1024", 43, "v_")
    return {
        "token_offsets": f"{offs_only} SELECT doc_id, n_tokens, start FROM offs",
        "sample_windows": f"""{offs_only},
            n AS (SELECT (sum(n_tokens) - {T} - 1)::BIGINT AS max_start FROM offs)
            SELECT range AS sample_id, ('0x' || substr(md5('42:' || range), 1, 15))::BIGINT % (SELECT max_start FROM n) AS start
            FROM range((SELECT max_start FROM n))""",
        "window_examples": f"{base} SELECT sample_id, start, x_sum, x_wsum, y_wsum FROM ex",
        "batch_examples": f"""{base} SELECT (sample_id // {BATCH})::BIGINT AS batch_id, count(*)::BIGINT AS n_examples,
              sum(x_sum)::BIGINT AS x_sum, min(sample_id) AS first_sample
            FROM ex WHERE sample_id < ((SELECT max_start FROM n) // {BATCH}) * {BATCH} GROUP BY 1""",
        "packed_batches": f"""{base} SELECT (sample_id // {BATCH})::BIGINT AS batch_id, count(*)::BIGINT AS n_examples,
              sum((sample_id % {BATCH} + 1) * x_sum)::BIGINT AS x_wsum,
              sum((sample_id % {BATCH} + 1) * (x_sum - first_id))::BIGINT AS y_wsum
            FROM (SELECT ex.*, tok.id AS first_id FROM ex JOIN tok ON tok.pos = ex.start)
            WHERE sample_id < ((SELECT max_start FROM n) // {BATCH}) * {BATCH} GROUP BY 1""",
        "cache_few_windows": f"{few} SELECT sample_id, start, x_sum, x_wsum, y_wsum FROM ex",
        "holdout_examples": f"""WITH {tr.strip()}, {va.strip()}
            SELECT sample_id, start, x_sum, x_wsum, y_wsum, 'train' AS split FROM t_ex
            UNION ALL SELECT sample_id, start, x_sum, x_wsum, y_wsum, 'val' AS split FROM v_ex""",
    }


def scores_sql() -> dict[str, str]:
    T, P = 0.9, 0.9
    e = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, (generate_subscripts(embedding, 1) - 1) AS item
              FROM embeddings)"""
    sm = f"""{e},
        s1 AS (SELECT vec_id, item, x / {T} AS s, max(x / {T}) OVER (PARTITION BY vec_id) AS m FROM e),
        sm AS (SELECT vec_id, item, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY vec_id) AS p FROM s1)"""
    nuc = f"""{sm},
        srt AS (SELECT vec_id, item, p, coalesce(sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, item
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS excl FROM sm),
        kept AS (SELECT vec_id, item, p FROM srt WHERE excl <= {P}),
        nuc AS (SELECT vec_id, item, p / (sum(p) OVER (PARTITION BY vec_id) + 1e-12) AS p FROM kept)"""
    return {
        "softmax_scores": f"WITH {sm} SELECT vec_id, item::BIGINT AS item, round(p, 6) AS prob FROM sm",
        "softmax_long": f"WITH {sm} SELECT vec_id, item::BIGINT AS item, round(p, 6) AS prob FROM sm",
        "top_p_long": f"WITH {nuc} SELECT vec_id, item::BIGINT AS item, round(p, 6) AS prob FROM nuc",
        "top_p_filter": f"WITH {nuc} SELECT vec_id, item::BIGINT AS item, round(p, 6) AS prob FROM nuc",
        "weighted_choice": f"""WITH {nuc},
            cum AS (SELECT vec_id, item, p, sum(p) OVER (PARTITION BY vec_id ORDER BY p DESC, item
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c,
                    row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, item) AS rk FROM nuc),
            u AS (SELECT DISTINCT vec_id, ('0x' || substr(md5('42:' || vec_id), 1, 15))::BIGINT::DOUBLE / {float(16**15)} AS u
                  FROM nuc)
            SELECT cum.vec_id, coalesce(min_by(item, rk) FILTER (WHERE c > u.u), max_by(item, rk))::BIGINT AS item
            FROM cum JOIN u USING (vec_id) GROUP BY cum.vec_id""",
        "greedy_choice": f"""WITH {e} SELECT vec_id, arg_min(item, [-x, item])::BIGINT AS item FROM e GROUP BY vec_id""",
        "eval_loss": f"""WITH {e},
            ce AS (SELECT vec_id, ln(sum(exp(x - m))) + max(m) - max(CASE WHEN item = label THEN x END) AS ce FROM (
                     SELECT vec_id, label, item, x, max(x) OVER (PARTITION BY vec_id) AS m FROM e) GROUP BY vec_id),
            r AS (SELECT vec_id, ce, (row_number() OVER (ORDER BY vec_id) - 1) // 32 AS b,
                         count(*) OVER () AS n FROM ce),
            bm AS (SELECT b, avg(ce) AS m FROM r WHERE b < n // 32 GROUP BY b)
            SELECT round(coalesce(avg(m), 0.0), 6) AS loss, count(*)::BIGINT AS n_batches FROM bm""",
    }


def more_sql() -> dict[str, str]:
    def clean(src: str, cols: str) -> str:
        return f"""(SELECT {cols}, t AS text FROM (SELECT {cols}, {strip_sql("coalesce(text, '')")} AS t FROM {src})
                   WHERE length(t) > 0)"""

    merged = f"""(SELECT 0::BIGINT AS source_rank, doc_id::BIGINT AS k1, 0::BIGINT AS k2, text FROM {clean('documents', 'doc_id')}
        UNION ALL SELECT 1, conv_id, turn, text FROM {clean('conversations', 'conv_id, turn')}
        UNION ALL SELECT 2, item_id, 0, text FROM {clean('benchmark', 'item_id')})"""
    layout = f"""layout AS MATERIALIZED (SELECT doc_id, text, strlen(text)::BIGINT AS nbytes, length(text)::BIGINT AS nchars,
            (sum(strlen(text) + 17) OVER w - (strlen(text) + 17))::BIGINT AS start,
            (sum(length(text) + 17) OVER w - (length(text) + 17))::BIGINT AS cstart
          FROM {CLEAN_DOCS_F} WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
        size AS MATERIALIZED (SELECT sum(nbytes + 17)::BIGINT AS s FROM layout),
        delims AS MATERIALIZED (SELECT start + nbytes + 2 AS pos, cstart + nchars + 2 AS cpos FROM layout),
        guesses AS MATERIALIZED (SELECT i, i * greatest((SELECT s FROM size) // 8, 1) AS g FROM range(1, 8) t(i)),
        moved AS MATERIALIZED (SELECT i, coalesce((SELECT min(pos) FROM delims WHERE pos >= g), (SELECT s FROM size)) AS b
          FROM guesses),
        bounds AS MATERIALIZED (SELECT DISTINCT b FROM (SELECT 0::BIGINT AS b UNION ALL SELECT b FROM moved
          UNION ALL SELECT s FROM size)),
        ob AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY b) - 1)::BIGINT AS idx, b,
          lead(b) OVER (ORDER BY b) AS e FROM bounds)"""
    return {
        "dedupe_merged": f"""SELECT min_by(source_rank, {{'r': source_rank, 'a': k1, 'b': k2}}) AS source_rank,
                min_by(k1, {{'r': source_rank, 'a': k1, 'b': k2}}) AS k1, min_by(k2, {{'r': source_rank, 'a': k1, 'b': k2}}) AS k2,
                min_by(text, {{'r': source_rank, 'a': k1, 'b': k2}}) AS text, fp
            FROM (SELECT *, {fp_sql('text')} AS fp FROM {merged}) GROUP BY fp""",
        "dedupe_resume": f"""WITH c AS (SELECT doc_id, text, {fp_sql('text')} AS fp,
                     coalesce((SELECT lang FROM documents d WHERE d.doc_id = x.doc_id) = 'en', false) AS earlier
                     FROM {CLEAN_DOCS_F} x),
              old AS (SELECT DISTINCT fp FROM c WHERE earlier),
              batch AS (SELECT min(doc_id) AS doc_id, min_by(text, doc_id) AS text, fp FROM c WHERE NOT earlier GROUP BY fp)
            SELECT doc_id, text, fp FROM batch WHERE fp NOT IN (SELECT fp FROM old)""",
        "chunk_boundaries": f"WITH {layout} SELECT idx, b AS byte_offset FROM ob",
        "seek_boundaries": f"WITH {layout} SELECT idx, b AS byte_offset FROM ob",
        "positioned_corpus": f"WITH {layout} SELECT text, start + nbytes + 2 AS end_byte FROM layout",
        "corpus_chunks": f"""WITH {layout},
            cpos AS (SELECT b, coalesce((SELECT min(cpos) FROM delims WHERE pos = b), CASE WHEN b = 0 THEN 0 END,
                     (SELECT sum(nchars + 17) FROM layout)) AS c FROM bounds)
            SELECT idx AS chunk_id, ob.b AS start_byte, ob.e AS end_byte, (ob.e - ob.b)::BIGINT AS length,
                   ((SELECT c FROM cpos WHERE cpos.b = ob.e) - (SELECT c FROM cpos WHERE cpos.b = ob.b))::BIGINT AS chars
            FROM ob WHERE ob.e IS NOT NULL""",
        "chunk_preview": f"""WITH {layout},
            file AS (SELECT string_agg(text || chr(10) || chr(10) || '{EOT}' || chr(10) || chr(10), '' ORDER BY doc_id) AS f
                     FROM layout),
            cpos AS (SELECT b, coalesce((SELECT min(cpos) FROM delims WHERE pos = b), 0) AS c FROM bounds)
            SELECT idx AS chunk_id,
                   replace(substring((SELECT f FROM file), (SELECT c FROM cpos WHERE cpos.b = ob.b) + 1, 200), chr(10), '\\n')
                     AS preview
            FROM ob WHERE ob.e IS NOT NULL""",
    }


def io_sql() -> dict[str, str]:
    bpe = bpe_sql()
    stream = f"""WITH docs AS (SELECT doc_id, list_concat({bytes_list_sql('text')}, [256]) AS ids FROM {CLEAN_DOCS_F}),
        offs AS (SELECT doc_id, ids, sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 - len(ids) AS start FROM docs),
        tok AS (SELECT start + i - 1 AS pos, id FROM (SELECT start, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM offs)),
        blocks AS (SELECT (pos // 4096)::BIGINT AS block_id, count(*)::BIGINT AS n_tokens, sum(id)::BIGINT AS id_sum
                   FROM tok GROUP BY 1)"""
    return {
        "write_corpus": f"SELECT count(*)::BIGINT AS docs, sum(strlen(text) + 17)::BIGINT AS bytes FROM {CLEAN_DOCS_F}",
        "read_corpus": f"""SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS doc_seq,
            {strip_sql("regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g')")} AS text FROM {CLEAN_DOCS_F}""",
        "append_corpus": f"""SELECT (row_number() OVER (ORDER BY NOT coalesce(d.lang = 'en', false), c.doc_id) - 1)::BIGINT AS doc_seq,
            {strip_sql("regexp_replace(c.text, chr(13) || chr(10) || '?', chr(10), 'g')")} AS text
            FROM {CLEAN_DOCS_F} c JOIN documents d USING (doc_id)""",
        "append_deduped": f"""WITH c AS (SELECT NOT coalesce(d.lang = 'en', false) AS late, c.doc_id, c.text, {fp_sql('c.text')} AS fp
              FROM {CLEAN_DOCS_F} c JOIN documents d USING (doc_id)),
            kept AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY fp ORDER BY late, doc_id) = 1)
            SELECT row_number() OVER (ORDER BY late, doc_id) - 1 AS doc_seq, text, fp FROM kept""",
        "clean_corpus": f"""WITH c AS (SELECT doc_id,
              {fp_sql("regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g')")} AS fp FROM {CLEAN_DOCS_F})
            SELECT (row_number() OVER (ORDER BY d) - 1)::BIGINT AS doc_seq, fp FROM (SELECT min(doc_id) AS d, fp FROM c GROUP BY fp)""",
        "raw_chunks": more_sql()["corpus_chunks"],
        "trained_roundtrip": f"SELECT doc_id, text FROM {CLEAN_DOCS_F}",
        "token_totals": f"""SELECT count(*)::BIGINT AS docs, sum(strlen(text))::BIGINT AS bytes, sum(len({pretok_sql('text')}))::BIGINT AS pretokens,
            sum({n_ids_sql('e')})::BIGINT AS tokens,
            max(list_max(list_transform(string_split({ids_str_sql('e')}, ' '), lambda x: x::BIGINT)))::BIGINT AS max_id, 'uint16' AS width
            FROM (SELECT text, {enc_text_sql('text')} AS e FROM {CLEAN_DOCS_F})""",
        "cache_windows": windows_sql()["window_examples"],
        "bpe_train_corpus": bpe["bpe_train"],
        "write_tokenizer": bpe["bpe_train"],
        "read_tokenizer": bpe["bpe_vocab"],
        "write_token_cache": f"""SELECT 257::BIGINT AS vocab_size, 256::BIGINT AS eot_token_id,
            sum(strlen(text) + 1)::BIGINT AS n_tokens, 4096::BIGINT AS block_size FROM {CLEAN_DOCS_F}""",
        "read_token_cache": f"{stream} SELECT block_id, n_tokens, id_sum FROM blocks",
        "tokens_cached": f"{stream} SELECT block_id, n_tokens, id_sum, true AS reused FROM blocks",
    }


def stream_sql() -> dict[str, str]:
    return {
        "stream_token_cache": f"""WITH docs AS (SELECT NOT coalesce(d.lang = 'en', false) AS late, c.doc_id,
              {enc_text_sql('c.text')} || '<{FIXED_EOT}>' AS e FROM {CLEAN_DOCS_F} c JOIN documents d USING (doc_id)),
            ids AS (SELECT late, doc_id, unnest(string_split({ids_str_sql('e')}, ' '))::BIGINT AS id,
              generate_subscripts(string_split({ids_str_sql('e')}, ' '), 1) AS place FROM docs),
            placed AS (SELECT id, row_number() OVER (ORDER BY late, doc_id, place) - 1 AS n FROM ids)
            SELECT n // 4096 AS block_id, count(*) AS n_tokens, sum(id * (n % 4096 + 1))::BIGINT AS checksum FROM placed GROUP BY 1""",
        "stream_corpus": f"SELECT text FROM {CLEAN_DOCS_F}",
        "stream_clean": f"SELECT doc_id, text FROM {CLEAN_DOCS_F}",
        "stream_dedupe": f"SELECT DISTINCT {fp_sql('text')} AS fp FROM {CLEAN_DOCS_F}",
        "stream_known": f"""WITH c AS (SELECT {fp_sql('text')} AS fp,
              coalesce((SELECT lang FROM documents d WHERE d.doc_id = x.doc_id) = 'en', false) AS earlier FROM {CLEAN_DOCS_F} x)
            SELECT DISTINCT fp FROM c WHERE fp NOT IN (SELECT fp FROM c WHERE earlier)""",
        "stream_resume": f"SELECT DISTINCT {fp_sql('text')} AS fp FROM {CLEAN_DOCS_F}",
        "stream_flush": f"SELECT text FROM {CLEAN_DOCS_F}",
        "stream_encode": f"""SELECT fp, {n_ids_sql('e')}::BIGINT AS n_tokens, {ids_str_sql('e')} AS ids FROM (
            SELECT {fp_sql('text')} AS fp, {enc_text_sql('text')} || '<{FIXED_EOT}>' AS e FROM {CLEAN_DOCS_F})""",
    }
