"""DuckDB statements that the registered queries must agree with."""

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format(text=LOWER.format(text="coalesce(text, '')"))} AS w FROM documents
), shingles AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, len(s) AS n FROM shingles
), flat AS (
    SELECT doc_id, unnest(s) AS x FROM shingles
), common AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared
    FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT u, v FROM common JOIN sizes p ON p.doc_id = u JOIN sizes q ON q.doc_id = v
    WHERE 100 * shared >= 80 * (p.n + q.n - shared)
), sides AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach AS (
    SELECT DISTINCT u AS a, u AS b FROM sides
    UNION
    SELECT a, v FROM reach JOIN sides ON b = u
), component AS (
    SELECT a, min(b) AS c FROM reach GROUP BY a
)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id,
       coalesce(c, doc_id) = doc_id AS kept
FROM sizes LEFT JOIN component ON a = doc_id
"""

SUBSTRING_DEDUP = f"""
WITH words AS (
    SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS x
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
), first AS (
    SELECT x, min(doc_id) AS owner FROM windows GROUP BY x
), copied AS (
    SELECT doc_id, i FROM windows JOIN first USING (x) WHERE doc_id > owner
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM copied
), marked AS (
    SELECT doc_id, list(j) AS js FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN js IS NULL THEN w ELSE
           list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(js, k)),
                          lambda k: w[k]) END, ' ')) AS kept_sha256
FROM words LEFT JOIN marked USING (doc_id)
"""

# Knots of the three schedules as in `mixing`: (from, to, weight at from, weight at to).
_PIECES = {
    0: [(0.0, 1.0, 1.5, 0.5)],
    1: [(0.0, 0.5, 1.0, 1.25), (0.5, 1.0, 1.25, 0.75)],
    2: [(0.0, 1.0, 0.5, 1.5)],
}


def _time(share: str) -> str:
    cases = []
    for k, pieces in _PIECES.items():
        whole = sum((b - a) * (v + w) / 2 for a, b, v, w in pieces)
        done, inner = 0.0, []
        for a, b, v, w in pieces:
            asked = f"({share} * {whole}::DOUBLE - {done}::DOUBLE)"
            slope = 2 * (w - v) / (b - a)
            root = f"sqrt(greatest({v * v}::DOUBLE + {asked} * ({slope})::DOUBLE, 0.0::DOUBLE))"
            time = f"{a}::DOUBLE + {asked} * 2.0::DOUBLE / ({root} + {v}::DOUBLE)"
            done += (b - a) * (v + w) / 2
            inner.append(f"WHEN {share} * {whole}::DOUBLE < {done}::DOUBLE THEN {time}")
        cases.append(f"WHEN class % 3 = {k} THEN CASE {' '.join(inner)} ELSE 1.0::DOUBLE END")
    return f"round(CASE {' '.join(cases)} END, 9)"


MIXING = f"""
WITH sized AS (
    SELECT doc_id, source, len({WORDS.format(text="coalesce(text, '')")})::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::DOUBLE AS s, 2.0::DOUBLE * sum(size)::DOUBLE AS most,
           ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 AS class
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][class + 1] AS w FROM sources
), levels AS (
    SELECT *, (sum(s) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER below, 0))
              / (sum(w) OVER () - coalesce(sum(w) OVER below, 0)) AS level
    FROM weighed
    WINDOW below AS (ORDER BY most / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), water AS (
    SELECT arg_min(level, most / w) AS level FROM levels WHERE level * w <= most
), targets AS (
    SELECT source, s::BIGINT AS source_size, class,
           round(least(most, coalesce((SELECT level FROM water) * w, most)), 6) AS target
    FROM weighed
), streamed AS (
    SELECT d.*, t.source_size, t.target, t.class,
           floor(t.target + 0.5)::BIGINT AS quota,
           (sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                            ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
    SELECT *, CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS p FROM streamed
), takes AS (
    SELECT *, p * size + least(greatest(quota - p * source_size - start, 0), size) AS taken FROM passes
)
SELECT doc_id, source, size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN {_time("(start / greatest(target, 1.0::DOUBLE))")} END AS "position",
       CASE WHEN taken > size THEN
           {_time("((start + source_size) / greatest(target, 1.0::DOUBLE))")} END AS again
FROM takes
"""

URL_RULES = r"""
WITH rules (verdict, host, path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
), fits AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict
    FROM parts p LEFT JOIN rules r
      ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
       coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM fits GROUP BY page_id, host, path
"""

TOP_K = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(
               range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id != c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id, score
FROM scores
QUALIFY rank <= 10
"""

_SHARE = "(1 + (1000000000::HUGEINT * ({n} + 1)) // ({total}))::BIGINT"

DIVERGENCE = rf"""
WITH found AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({LOWER.format(text="coalesce(text, '')")},
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), words AS (
    SELECT r, lang, source, unnest(terms) AS term FROM found
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL
), kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(lang_n) AS lang_sum FROM kept GROUP BY lang
), sums AS (
    SELECT lang, source, sum(n) AS n_sum FROM counts JOIN kept USING (lang, term) GROUP BY lang, source
), groups AS (
    SELECT lang, source, coalesce(v, 0) AS v, coalesce(n_sum, 0) + coalesce(v, 0) AS total,
           coalesce(lang_sum, 0) + coalesce(v, 0) AS lang_total
    FROM (SELECT DISTINCT lang, source FROM found) LEFT JOIN langs USING (lang)
         LEFT JOIN sums USING (lang, source)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           {_SHARE.format(n="coalesce(c.n, 0)", total="g.total")} AS p,
           {_SHARE.format(n="k.lang_n", total="g.lang_total")} AS q
    FROM groups g JOIN kept k ON k.lang = g.lang
         LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), costs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source
    GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
         LEFT JOIN costs c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
), terms AS (
    SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
    FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, (row_number() OVER (
           PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""


def _codes() -> str:
    steps = []
    for k in range(7):
        steps.append(f"""d{k} AS (
    SELECT p.rid, p.j, b.e, b.c, list_sum(list_transform(range(1, len(p.x) + 1),
               lambda i: (p.x[i] - b.c[i]) * (p.x[i] - b.c[i])))::BIGINT AS d
    FROM parts p JOIN b{k} b ON p.j = b.j
), a{k} AS (
    SELECT rid, j, e, c, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY rid, j ORDER BY d, e) = 1
)""")
        if k < 6:  # floored means; an entry without parts stays
            steps.append(f"""m{k} AS (
    SELECT j, e, i, sum(x[i])::HUGEINT AS s, count(*) AS n
    FROM (SELECT a.j, a.e, p.x, unnest(range(1, len(p.x) + 1)) AS i
          FROM a{k} a JOIN parts p ON a.rid = p.rid AND a.j = p.j)
    GROUP BY j, e, i
), b{k + 1} AS (
    SELECT b.j, b.e, coalesce(l.c, b.c) AS c
    FROM b{k} b LEFT JOIN (
        SELECT j, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM m{k} GROUP BY j, e
    ) l ON b.j = l.j AND b.e = l.e
)""")
    chain = ",\n".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)
    return f"""
WITH usable AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
           list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT rid, j, v[j * (len(v) // 8) + 1 : (j + 1) * (len(v) // 8)] AS x
    FROM usable, (SELECT unnest(range(0, 8)) AS j)
), b0 AS MATERIALIZED (
    SELECT j, rid - 1 AS e, x AS c FROM parts WHERE rid <= 16
), {chain}, found AS (
    SELECT rid, string_agg(printf('%02x', e::INTEGER), '' ORDER BY j) AS code, sum(d)::BIGINT AS error
    FROM a6 GROUP BY rid
), labels AS (
    SELECT label, sum(error)::BIGINT AS label_error FROM found JOIN usable USING (rid) GROUP BY label
), sha AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY j, e)) AS codebooks_sha256 FROM b6
)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM found JOIN usable u USING (rid) JOIN labels l ON u.label IS NOT DISTINCT FROM l.label, sha
"""


VECTOR_CODES = _codes()

# Texts as hexadecimal digits: two of them are a byte.
REPEATED_BYTES = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), windows AS (
    SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS x
    FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM texts)
), repeated AS (
    SELECT r, i FROM windows SEMI JOIN (SELECT x FROM windows GROUP BY x HAVING count(*) > 1) USING (x)
), stretches AS (
    SELECT r, min(i) AS a, max(i) + 400 AS b
    FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS k
          FROM (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new
                FROM repeated))
    GROUP BY r, k
), kept AS (
    SELECT r, b AS a, lead(a) OVER (PARTITION BY r ORDER BY a) AS b FROM stretches
    UNION ALL SELECT r, 0, min(a) FROM stretches GROUP BY r
), cut AS (
    SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, length(h) // 2) - a)), '' ORDER BY a) AS k
    FROM kept JOIN texts USING (r) GROUP BY r
), spans AS (
    SELECT r, count(*) AS n, sum(b - a) AS gone FROM stretches GROUP BY r
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed,
       coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM texts LEFT JOIN spans USING (r) LEFT JOIN cut USING (r)
"""
