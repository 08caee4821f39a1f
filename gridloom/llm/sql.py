"""DuckDB SQL for the operators that SQL can express; names of tables are those of the data folder."""

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
b AS (SELECT r, doc_id, host, ws, ls, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        md5(t) AS digest FROM w),
g AS (SELECT r, unnest(generate_series(1, n_words - 2)) AS i, ws FROM b WHERE n_words > 2),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY r),
l AS (SELECT r, host, digest, unnest(list_transform(ls, lambda x: array_to_string(regexp_extract_all(
        translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '{WORD}'), ' '))) AS line FROM b),
h AS (SELECT host, count(DISTINCT digest) AS n FROM b GROUP BY host),
common AS (SELECT l.host, line FROM l JOIN h ON l.host = h.host GROUP BY l.host, line, h.n
        HAVING count(DISTINCT digest) > 25 AND count(DISTINCT digest) > 0.01 * h.n),
gone AS (SELECT r, sum(len(string_split(line, ' '))) AS words_removed FROM l JOIN common USING (host, line) GROUP BY r),
f AS (SELECT b.*, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(words_removed, 0)::BIGINT AS words_removed,
        n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
      FROM b LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - words_removed >= 0.3 * n_words AS kept, words_removed FROM f
"""

LINE_DEDUP = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text AS t FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(generate_series(1, len(ls))) AS i FROM (SELECT r, doc_id, string_split(t, chr(10)) AS ls FROM d WHERE t IS NOT NULL)),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 12))::HUGEINT AS h FROM l),
e AS (SELECT *, (h + 31 * coalesce(lag(h) OVER w, 0) + 961 * coalesce(lag(h, 2) OVER w, 0)) % 4 = 0 AS cut FROM h WINDOW w AS (PARTITION BY r ORDER BY i)),
s AS (SELECT *, coalesce(max(CASE WHEN cut THEN i END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS since FROM e),
k AS (SELECT *, coalesce(sum((cut OR (i - since) % 64 = 0)::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM s),
c AS (SELECT r, doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS passage, count(*) AS n, sum(regexp_matches(line, '{WORD}')::INT) > 1 AS several
      FROM k GROUP BY r, doc_id, chunk),
f AS (SELECT passage, min((doc_id, chunk)) AS first FROM c WHERE several GROUP BY passage),
m AS (SELECT c.*, several AND (c.doc_id, c.chunk) <> f.first AS gone FROM c LEFT JOIN f ON several AND c.passage = f.passage),
o AS (SELECT r, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS n_lines_removed, count(*) FILTER (WHERE gone) AS n_chunks_removed,
        coalesce(string_agg(passage, chr(10) ORDER BY chunk) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed, coalesce(n_chunks_removed, 0) AS n_chunks_removed,
    sha256(kept) AS text_sha256 FROM d LEFT JOIN o USING (r)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS x FROM p),
f AS (SELECT x, min(page_id) AS first FROM s GROUP BY x)
SELECT page_id, payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(s.x, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM s JOIN f USING (x)
"""

SUFFIX = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
k AS MATERIALIZED (SELECT r, doc_id, p, md5(substr(h, 2 * p + 1, 100)) AS s FROM (SELECT r, doc_id, h, unnest(generate_series(0, n - 50)) AS p FROM d WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS first FROM k GROUP BY s),
g AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) > 50 AS gap FROM k JOIN f USING (s) WHERE doc_id > first),
i AS (SELECT r, p, sum(coalesce(gap, true)::INT) OVER (PARTITION BY r ORDER BY p) AS run FROM g),
runs AS (SELECT r, run, min(p) AS lo, max(p) + 50 AS hi FROM i GROUP BY r, run),
cut AS (SELECT runs.r, lo, hi, substr(h, 2 * coalesce(lag(hi) OVER w, 0) + 1, 2 * (lo - coalesce(lag(hi) OVER w, 0))) AS part FROM runs JOIN d USING (r) WINDOW w AS (PARTITION BY runs.r ORDER BY lo)),
o AS (SELECT r, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(part, '' ORDER BY lo) AS head, max(hi) AS last FROM cut GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256 FROM d LEFT JOIN o USING (r)
"""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = rf"""
WITH t AS MATERIALIZED (SELECT r, doc_id, unnest(ts) AS term, len(ts) AS n FROM (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS ts FROM documents)),
f AS MATERIALIZED (SELECT r, any_value(doc_id) AS doc_id, term, any_value(n)::BIGINT AS n, count(*) AS tf FROM t GROUP BY r, term),
c AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM (SELECT DISTINCT r, n FROM f)),
w AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, c GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term
        FROM benchmark),
s AS (SELECT item_id, r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
        FROM q JOIN w USING (term) JOIN f USING (term), c GROUP BY item_id, r),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM o WHERE rank <= 50
"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


def _folded(table: str, steps: int, first: str) -> str:
    """CTEs `table`0 .. `table``steps`: every run of three nodes becomes its hash in trees that have more than one node."""
    out = [f"{table}0 AS MATERIALIZED ({first})"]
    for k in range(steps):
        out.append(f"""{table}{k + 1} AS MATERIALIZED (SELECT tree, pos // 3 AS pos, (min(n) + 2) // 3 AS n,
        CASE WHEN min(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h FROM {table}{k} GROUP BY tree, pos // 3)""")
    return ",\n".join(out)


def _climbed(version: str, nodes: str, steps: int, first: str) -> str:
    """CTEs `version`0 .. `version``steps`: each row's own node is folded with its siblings, which are added to its proof."""
    out = [f"{version}0 AS MATERIALIZED ({first})"]
    for k in range(steps):
        out.append(f"""{version}{k + 1} AS MATERIALIZED (SELECT r, any_value(v.tree) AS tree, any_value(v.pos) // 3 AS pos,
        CASE WHEN min(x.n) = 1 THEN min(v.h) ELSE sha256(string_agg(CASE WHEN x.pos = v.pos THEN v.h ELSE x.h END, '' ORDER BY x.pos)) END AS h,
        any_value(proof) || coalesce(string_agg(x.h, '' ORDER BY x.pos) FILTER (x.pos <> v.pos), '') AS proof
        FROM {version}{k} v JOIN {nodes}{k} x ON x.tree = v.tree AND x.pos // 3 = v.pos // 3 GROUP BY r)""")
    return ",\n".join(out)


#: Trees of up to 3 ** 10 documents a source and 3 ** 5 sources.
MERKLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source,
        sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))}) AS leaf,
        sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', "replace(text, chr(10), '')"))}) AS tampered,
        list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda b: [ascii(b)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))) AS crc FROM documents),
p AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{_folded('s', 10, 'SELECT tree, pos, n, leaf AS h FROM p')},
{_folded('t', 5, 'SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, h FROM s10')},
{_climbed('v', 's', 10, "SELECT r, tree, pos, CASE WHEN (4294967295 - crc) % 2 = 0 THEN tampered ELSE leaf END AS h, '' AS proof FROM p")},
{_climbed('w', 't', 5, 'SELECT r, 0 AS tree, tree AS pos, h, proof FROM v10')}
SELECT doc_id, leaf, s10.h AS subroot, t5.h AS root, sha256(proof) AS proof_sha256, w5.h AS folded_root, w5.h = t5.h AS verified
FROM p JOIN s10 ON s10.tree = p.tree JOIN w5 USING (r), t5
"""
