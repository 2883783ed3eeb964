"""DuckDB SQL for the queries that SQL can express.

Without SQL, and tested against plain versions in tests/llm instead: op3 (weighted votes of positions), op4 (alignment),
op5 (XXH64 majorities and components), op8 (byte-pair merges), op11 and op13 (ids of tokenizers) and the pipeline.
"""

from __future__ import annotations

from adtrail.llm import quality
from adtrail.llm.queries import URL_RULES
from adtrail.llm.secret_ledger import BASE_KINDS, RULES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secret_hits() -> str:
    """(doc_id, start, rank, kind, end): positions are sums over the pieces between matches."""
    parts = []
    for rank, rule in enumerate(RULES):
        p = _quoted(rule.pattern)
        parts.append(f"""SELECT doc_id, rank, kind, s.a AS "start", s.b AS "end" FROM (
            SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, unnest(list_filter(list_transform(range(1, len(hits) + 1), lambda i: {{
                'a': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0),
                'b': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + list_sum(list_transform(hits[1:i], lambda x: length(x))),
                'ok': length(judged[i]) >= {rule.least}}}), lambda s: s.ok)) AS s
            FROM (SELECT doc_id, string_split_regex(text, {p}) AS gaps, regexp_extract_all(text, {p}, 0) AS hits, regexp_extract_all(text, {p}, {rule.group}) AS judged
                FROM documents WHERE regexp_matches(text, {p})))""")
    return " UNION ALL ".join(parts)


def _secrets() -> str:
    listed = lambda where: f"coalesce(string_agg(kind || ':' || \"start\" || ':' || \"end\", ',' ORDER BY \"start\", rank) FILTER (WHERE {where}), '')"
    base = ", ".join(map(_quoted, BASE_KINDS))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""WITH hits AS ({_secret_hits()}),
    per AS (SELECT doc_id, {counts}, {listed(f'kind IN ({base})')} AS base, {listed('TRUE')} AS spans FROM hits GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
        coalesce(spans, '') AS spans, sha256(coalesce(d.text, '')) AS blob_id FROM documents d LEFT JOIN per USING (doc_id)"""


def _urls() -> str:
    rules = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in URL_RULES)
    return f"""WITH parts AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    named AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path
        FROM (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM parts)),
    rules AS (SELECT * FROM (VALUES {rules}) AS v(rh, rp, verdict))
    SELECT page_id, host, path, rh || rp AS rule, coalesce(verdict, 'allow') AS verdict FROM named LEFT JOIN rules
        ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY len(string_split(rh, '.')) DESC NULLS LAST, length(rp) DESC) = 1"""


def _shards() -> str:
    unit = "CAST('0x' || substr(md5('k' || doc_id || '#' || s), 1, 13) AS BIGINT)"
    best = lambda n: f"(SELECT doc_id, arg_max(s, ({unit}, -s)) AS shard FROM documents, range({n}) t(s) GROUP BY doc_id)"
    return f"""WITH bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
    tab AS (SELECT list(list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t FROM range(256) r(n)),
    crc AS (SELECT doc_id, size, xor(list_reduce(list_transform(range(size - 8), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS c FROM bytes, tab)
    SELECT doc_id, size, c AS text_crc32, 'key' AS law, a.shard::INT AS shard, row_number() OVER (PARTITION BY a.shard ORDER BY md5('k' || doc_id), doc_id) - 1 AS slot, b.shard::INT AS grown_shard
    FROM crc JOIN {best(24)} a USING (doc_id) JOIN {best(25)} b USING (doc_id)"""


_SUBSTRINGS = f"""WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
    flat AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
    win AS (SELECT doc_id, unnest(range(1, len(words) - 48)) AS pos, words FROM w WHERE len(words) >= 50),
    dup AS (SELECT doc_id, pos, doc_id > min(doc_id) OVER (PARTITION BY array_to_string(words[pos:pos + 49], ' ')) AS later FROM win),
    marked AS (SELECT f.*, coalesce(bool_or(later) OVER (PARTITION BY f.doc_id ORDER BY f.pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), FALSE) AS gone
        FROM flat f LEFT JOIN dup USING (doc_id, pos))
    SELECT d.doc_id, count(word) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id"""

_WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
    d AS (SELECT *, sha1(body) AS h FROM p)
    SELECT page_id, octet_length(encode(body)) AS payload_bytes,
        array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([32768, 1024, 32, 1], lambda q:
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT) // q) % 32, 1)), '')), '') AS payload_digest,
        CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d"""


def _quality() -> str:
    share = lambda a, b: f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} ELSE 0.0 END"
    values = {
        "symbol_share": share("n_symbols", "word_chars"), "repeat_share": share("n_repeat_words", "n_words"), "dup_line_share": share("n_dup_lines", "n_lines"),
        "upper_share": share("n_upper", "n_letters"), "mark_share": share("n_marks", "word_chars"), "mean_word": share("word_chars", "n_words"),
    }
    kept = lambda pattern: f"length(regexp_replace(joined, '{pattern}', '', 'g'))"
    least = -(10**6)
    longest = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, CASE WHEN {v} > 1e-6 THEN CAST(ceil(ln({v}) / ln({quality.GROWTH})) AS INT) ELSE {least} END AS bucket FROM m" for m, v in values.items())
    quantile = lambda q, name: f"min(CASE WHEN upto >= whole * {q} THEN CASE WHEN bucket > {least} THEN pow({quality.GROWTH}, bucket) ELSE 0.0 END END) AS {name}"
    broken = []
    for m, (slack, lower) in quality.MEASURES.items():
        broken.append(f"(q.measure = '{m}' AND ({values[m]} > mid + {quality.REACH} * (high - mid + {slack})" + (f" OR {values[m]} < mid - {quality.REACH} * (mid - low + {slack})" if lower else "") + "))")
    return rf"""WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS words FROM documents),
    runs AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS pos, words FROM w WHERE len(words) >= 8),
    twice AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, array_to_string(words[pos:pos + 7], ' ')) > 1 AS again FROM runs),
    reps AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, pos + unnest(range(8)) AS word FROM twice WHERE again) GROUP BY doc_id),
    lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    c AS (SELECT *, array_to_string(words, '') AS joined FROM w),
    m AS (SELECT c.doc_id, lang, source, len(words) AS n_words, length(joined) AS word_chars, length(joined) - {kept('[#*$%&|<>]')} AS n_symbols,
        coalesce(n_dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, length(joined) - {kept('[A-Z]')} AS n_upper,
        length(joined) - {kept('[A-Za-z]')} AS n_letters, length(joined) - {kept('[!-/:-@[-`{-~]')} AS n_marks
        FROM c LEFT JOIN reps r USING (doc_id) LEFT JOIN lines l USING (doc_id)),
    sketch AS (SELECT lang, source, measure, bucket, count(*) AS n FROM ({longest}) GROUP BY ALL),
    upto AS (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS whole FROM sketch),
    q AS (SELECT lang, source, measure, {quantile(0.25, 'low')}, {quantile(0.5, 'mid')}, {quantile(0.75, 'high')} FROM upto GROUP BY lang, source, measure),
    failed AS (SELECT DISTINCT m.doc_id FROM m JOIN q ON m.lang IS NOT DISTINCT FROM q.lang AND m.source IS NOT DISTINCT FROM q.source WHERE {' OR '.join(broken)}),
    base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM failed) AS kept FROM base"""


_COLLOCATIONS = r"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
    grams AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, 6) t(k) WHERE len(words) >= k)),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
    totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
    cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
    cuts AS (SELECT *, array_to_string(words[1:c], ' ') AS head, array_to_string(words[c + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS c FROM cand)),
    scores AS (SELECT c.lang, c.phrase, c.a, c.c, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.a * t.n) // (l.f::HUGEINT * r.f) AS score
        FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = head JOIN f r ON r.lang = c.lang AND r.phrase = tail JOIN totals t ON t.lang = c.lang),
    best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inside AS (SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer
        FROM (SELECT lang, a, words, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 5) t(m) WHERE m < k) GROUP BY ALL),
    left_over AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM left_over QUALIFY rank <= 2000"""


ORACLE: dict[str, str] = {
    "op1_secret_scan": _secrets(),
    "op2_url_filter": _urls(),
    "op6_shards": _shards(),
    "op7_substring_dedup": _SUBSTRINGS,
    "op9_warc": _WARC,
    "op10_quality_rules": _quality(),
    "op12_collocations": _COLLOCATIONS,
}
