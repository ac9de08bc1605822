"""SQL that must give the same rows as the queries of this package, built from the same tables of fixed values."""

from __future__ import annotations

from millrace.llm.chat import CLOSE, OPEN, Budget
from millrace.llm.decontaminate import WINDOW
from millrace.llm.mixing import DRAWS, MAX_REPEATS, SEED, WEIGHTS
from millrace.llm.quality import BASE_RULES, RULES, STOP_FORMS, SYMBOLS

# The word patterns of the result contracts.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _quality_cases(rules) -> str:
    terms = []
    for r in rules:
        if r.low is not None:
            terms.append(f"coalesce({r.metric} < {r.low}, false) AND n_words >= {r.min_words}")
        if r.high is not None:
            terms.append(f"coalesce({r.metric} > {r.high}, false) AND n_words >= {r.min_words}")
    return " OR ".join(terms)


def quality_sql(documents: str) -> str:
    """Common table expressions ending in ``judged``: every row of ``documents`` with its counts and verdicts."""
    stops = ", ".join(f"'{w}'" for w in STOP_FORMS)
    return f"""
    q_texts AS (SELECT row_number() OVER () AS k, *, coalesce(text, '') AS t FROM {documents}),
    q_words AS (
      SELECT *, regexp_extract_all(t, '{PLAIN_WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
      FROM q_texts),
    q_grams AS (
      SELECT k, i, array_to_string(ws[i : i + 4], ' ') AS g
      FROM (SELECT k, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM q_words)),
    q_again AS (SELECT k, i FROM q_grams QUALIFY count(*) OVER (PARTITION BY k, g) > 1),
    q_repeats AS (
      SELECT k, count(DISTINCT pos) AS n FROM (SELECT k, unnest(generate_series(i, i + 4)) AS pos FROM q_again) GROUP BY k),
    q_counts AS (
      SELECT q_words.*, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols,
             len(regexp_extract_all(t, '\\p{{Lu}}'))::BIGINT AS n_upper,
             len(list_filter(ws, lambda w: w IN ({stops})))::BIGINT AS n_stop,
             len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*\\z')))::BIGINT AS n_ellipsis,
             len(list_filter(ls, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•‣][\\x20\\x09-\\x0D]')))::BIGINT AS n_bullet,
             coalesce(q_repeats.n, 0)::BIGINT AS n_repeat_words
      FROM q_words LEFT JOIN q_repeats USING (k)),
    q_metrics AS (
      SELECT *, 100 * n_repeat_words / nullif(n_words, 0) AS repeat_percent,
             word_chars / nullif(n_words, 0) AS mean_word_chars, n_symbols / nullif(n_words, 0) AS symbols_per_word,
             n_stop / nullif(n_words, 0) AS stop_word_ratio, n_upper / nullif(word_chars, 0) AS upper_char_ratio,
             n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio, n_ellipsis / nullif(n_lines, 0) AS ellipsis_line_ratio,
             n_bullet / nullif(n_lines, 0) AS bullet_line_ratio
      FROM q_counts),
    judged AS (
      SELECT *, ({_quality_cases(BASE_RULES)}) AS base_failed,
             NOT ({_quality_cases(BASE_RULES)} OR {_quality_cases(RULES)}) AS kept
      FROM q_metrics)"""


QUALITY_RULES = f"""
WITH {quality_sql("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""


def mixing_sql(documents: str) -> str:
    """Common table expressions ending in ``mixed``: every row of ``documents`` with its size, target and copies."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS))
    return f"""
    m_sizes AS (
      SELECT *, len(regexp_extract_all(coalesce(text, ''), '{PLAIN_WORD}'))::BIGINT AS size FROM {documents}),
    m_sources AS (SELECT source, sum(size)::HUGEINT AS source_size FROM m_sizes GROUP BY source),
    m_weights AS (
      SELECT *, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {weight} END)::HUGEINT AS w
      FROM m_sources),
    m_steps AS (
      SELECT *, sum(source_size) OVER () - coalesce(sum({MAX_REPEATS} * source_size) OVER below, 0) AS num,
             sum(w) OVER () - coalesce(sum(w) OVER below, 0) AS den,
             row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS step
      FROM m_weights
      WINDOW below AS (
        ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    m_level AS (SELECT num, den FROM m_steps WHERE {MAX_REPEATS} * source_size * den >= w * num ORDER BY step LIMIT 1),
    m_targets AS (
      SELECT source, source_size::BIGINT AS source_size,
             least((w * num)::DOUBLE / den::DOUBLE, ({MAX_REPEATS} * source_size)::DOUBLE) AS target
      FROM m_weights, (SELECT max(num) AS num, max(den) AS den FROM m_level)),
    m_rates AS (
      SELECT s.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM m_sizes s JOIN m_targets t ON s.source IS NOT DISTINCT FROM t.source),
    m_draws AS (
      SELECT *, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
      FROM (SELECT *, ('0x' || substr(md5('{SEED}:' || draw || ':' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT
                      / 2.0 ** 52 AS u
            FROM m_rates, (SELECT unnest(range({DRAWS})) AS draw))),
    m_best AS (
      SELECT source, draw FROM m_draws GROUP BY source, draw
      QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(sum(copies * size) - any_value(target)), draw) = 1),
    mixed AS (
      SELECT d.* FROM m_draws d JOIN m_best b ON d.source IS NOT DISTINCT FROM b.source AND d.draw = b.draw)"""


MIX_SOURCES = f"""
WITH {mixing_sql("documents")}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mixed
"""


def _folded(text: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{lower}'), '{FOLDED_WORD}')"


def decontamination_sql(documents: str) -> str:
    """Common table expressions ending in ``checked``: every row of ``documents`` with its hits."""
    return f"""
    c_docs AS (SELECT row_number() OVER () AS k, *, {_folded("text")} AS ws FROM {documents}),
    c_items AS (SELECT item_id, {_folded("text")} AS ws FROM benchmark),
    c_windows AS (
      SELECT DISTINCT item_id, l, array_to_string(ws[s : s + l - 1], ' ') AS w
      FROM (SELECT item_id, ws, least(len(ws), {WINDOW}) AS l, unnest(generate_series(1, len(ws) - least(len(ws), {WINDOW}) + 1)) AS s
            FROM c_items WHERE len(ws) > 0)),
    c_lengths AS (SELECT DISTINCT l FROM c_windows),
    c_places AS (
      SELECT k, l, s, array_to_string(ws[s : s + l - 1], ' ') AS w
      FROM (SELECT k, ws, l, unnest(generate_series(1, len(ws) - l + 1)) AS s FROM c_docs, c_lengths WHERE len(ws) >= l)),
    c_hits AS (SELECT k, s, c_places.l, item_id FROM c_places JOIN c_windows USING (l, w)),
    c_covered AS (
      SELECT k, count(DISTINCT pos)::BIGINT AS n_hit FROM (SELECT k, unnest(generate_series(s, s + l - 1)) AS pos FROM c_hits)
      GROUP BY k),
    c_found AS (
      SELECT k, count(DISTINCT item_id)::BIGINT AS n_items,
             string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM c_hits GROUP BY k),
    checked AS (
      SELECT c_docs.*, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
             sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM c_docs LEFT JOIN c_covered USING (k) LEFT JOIN c_found USING (k))"""


DECONTAMINATE = f"""
WITH {decontamination_sql("documents")}
SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM checked
"""


def _chat() -> str:
    b, extra = Budget(), len(OPEN) + 1 + len(CLOSE)
    escaped = "length({0}) + length({0}) - length(replace(replace(replace({0}, '\\', ''), '<', ''), '#', ''))"
    role_breaks = "length(role) - length(replace(role, chr(10), ''))"
    return f"""
    WITH rows AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
             len(regexp_extract_all(text, '{PLAIN_WORD}')) + {b.per_turn} AS tokens,
             {escaped.format("role")} + {role_breaks} + {escaped.format("text")} + {extra} AS chars
      FROM rows),
    kinds AS (SELECT *, place = 1 AND role = 'system' AS system FROM placed),
    sums AS (
      SELECT *, coalesce(sum(CASE WHEN system THEN 0 ELSE tokens END) OVER (
                  PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             max(CASE WHEN system THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id) AS fixed
      FROM kinds),
    slots AS (
      SELECT *, floor(before / greatest(1, floor(({b.tokens} - {b.history} - fixed) / 2))) AS slot FROM sums),
    spans AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY slot) - 1 AS span FROM slots),
    starts AS (SELECT conv_id, span, min(before) AS first FROM spans GROUP BY ALL),
    counted AS (
      SELECT s.*, CASE WHEN system THEN max(s.span) OVER (PARTITION BY s.conv_id) + 1
                       WHEN before >= n.first - {b.history} THEN 2 ELSE 1 END AS times
      FROM spans s LEFT JOIN starts n ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND n.span = s.span + 1)
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars * times)::BIGINT AS formatted_chars
    FROM counted GROUP BY conv_id
    """


CHAT = _chat()


# Base32 has no DuckDB function: 160 bits in groups of five, through the hexadecimal digits of the digest.
_BITS = "list_reduce(list_transform(string_split(sha1(h), ''), lambda c: lpad(bin(('0x' || c)::INTEGER), 4, '0')), lambda a, b: a || b)"
ARC_TO_WARC = f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
bits AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_BITS} AS b FROM bodies),
digests AS (
  SELECT page_id, payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           list_sum(list_transform(range(5), lambda j: substr(b, (5 * i + j + 1)::BIGINT, 1)::INTEGER * (16 >> j::INTEGER)))::BIGINT + 1, 1)), '')
           AS payload_digest
  FROM bits),
firsts AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
