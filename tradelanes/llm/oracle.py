"""DuckDB SQL of the corpus operators that SQL can express, from their definitions alone."""

from __future__ import annotations


def op6_sql(min_sites: int) -> str:
    return rf"""
    WITH parts AS (
        SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents),
    wide AS (
        SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first
        FROM parts WHERE regexp_matches(line, '[^ \t\r\f]')
        GROUP BY line HAVING count(DISTINCT source) >= {min_sites}),
    marked AS (
        SELECT p.*, w.line IS NOT NULL AND w.first <> struct_pack(doc_id := p.doc_id, pos := p.pos) AS gone
        FROM parts p LEFT JOIN wide w USING (line)),
    cleaned AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS clean
        FROM marked GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
           CASE WHEN d.text IS NOT NULL THEN sha256(clean) END AS clean_sha256
    FROM documents d LEFT JOIN cleaned c USING (doc_id)"""


def op10_sql(allow: tuple, block: tuple, link: str, damping: float, rounds: int, threshold: float) -> str:
    rules = ", ".join(f"('{r}', '{v}')" for v, rs in (("allow", allow), ("block", block)) for r in rs)
    link = link.replace("'", "''")
    walk = "\n".join(f"""
    s{i} AS MATERIALIZED (
        SELECT kind, host, {1 - damping!r} * seed + {damping!r} * coalesce(got, 0) AS score, n
        FROM start LEFT JOIN (
            SELECT kind, w.dst AS host, sum(r.score * w.share) AS got
            FROM s{i - 1} r JOIN ways w USING (kind) WHERE r.host = w.src GROUP BY ALL) USING (kind, host)),"""
                     for i in range(1, rounds + 1))
    return rf"""
    WITH rules(rule, verdict) AS (VALUES {rules}),
    parsed AS (
        SELECT page_id, coalesce(html, '') AS html,
               translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    ruled AS (
        SELECT p.page_id, p.host, p.path, p.html,
               arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
        FROM (SELECT *, row_number() OVER () AS nr FROM parsed) p
        LEFT JOIN (SELECT *, split_part(rule, '/', 1) AS domain, substr(rule, instr(rule, '/')) AS prefix FROM rules) r
          ON (p.host = r.domain OR ends_with(p.host, '.' || r.domain)) AND starts_with(p.path, r.prefix)
        GROUP BY p.nr, p.page_id, p.host, p.path, p.html),
    seeds AS (
        SELECT host, avg(CASE WHEN verdict = 'allow' THEN 1.0::DOUBLE ELSE 0 END) AS trust,
               avg(CASE WHEN verdict = 'block' THEN 1.0::DOUBLE ELSE 0 END) AS distrust
        FROM ruled WHERE host <> '' GROUP BY host),
    links AS (
        SELECT src, dst, count(*)::DOUBLE AS n FROM (
            SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
            FROM ruled WHERE host <> '') WHERE src <> dst GROUP BY ALL),
    named AS (SELECT host FROM ruled UNION SELECT dst FROM links),
    above AS (
        SELECT DISTINCT p[i] AS src, p[i + 1] AS dst FROM (
            SELECT p, unnest(range(1, len(p) - 1)) AS i FROM (
                SELECT list_transform(range(1, len(l) + 1), lambda i: array_to_string(l[i:], '.')) AS p
                FROM (SELECT string_split(host, '.') AS l FROM named WHERE host <> '')))),
    edges AS (
        SELECT src, dst, sum(n) AS n FROM (
            SELECT * FROM links UNION ALL SELECT src, dst, 1.0 FROM above UNION ALL SELECT dst, src, 1.0 FROM above) GROUP BY ALL),
    hosts AS (SELECT host FROM seeds UNION SELECT src FROM edges UNION SELECT dst FROM edges),
    looped AS (SELECT * FROM edges UNION ALL SELECT host, host, 1.0 FROM hosts),
    both_ways AS (SELECT 'trust' AS kind, src, dst, n FROM looped UNION ALL SELECT 'distrust', dst, src, n FROM looped),
    ways AS MATERIALIZED (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM both_ways),
    weights AS (
        SELECT 'trust' AS kind, host, coalesce(trust, 0) AS weight FROM hosts LEFT JOIN seeds USING (host)
        UNION ALL SELECT 'distrust', host, coalesce(distrust, 0) FROM hosts LEFT JOIN seeds USING (host)),
    start AS MATERIALIZED (
        SELECT kind, host, count(*) OVER (PARTITION BY kind) AS n,
               CASE WHEN sum(weight) OVER (PARTITION BY kind) > 0 THEN weight / sum(weight) OVER (PARTITION BY kind) ELSE 0 END AS seed
        FROM weights),
    s0 AS (SELECT kind, host, seed AS score, n FROM start),{walk}
    scored AS (
        SELECT host, sum(CASE WHEN kind = 'trust' THEN score * n ELSE 0 END) AS trust,
               sum(CASE WHEN kind = 'distrust' THEN score * n ELSE 0 END) AS distrust
        FROM s{rounds} GROUP BY host)
    SELECT page_id, host, path, rule,
           coalesce(verdict, CASE WHEN round(distrust - trust, 9) > {threshold!r} THEN 'block' ELSE 'allow' END) AS verdict
    FROM ruled LEFT JOIN scored USING (host)"""


#: One row: the table ``t`` of the 256 remainders of CRC-32, from its reversed polynomial.
CRC_TABLE = """
    crc AS MATERIALIZED (
        SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM (SELECT unnest(range(256)) AS i))"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text of code points under 2048, beside the table ``crc``."""
    point = f"ord(substr({text}, i::INT + 1, 1))::BIGINT"
    octets = f"flatten(list_transform(range(length({text})), lambda i: CASE WHEN {point} < 128 THEN [{point}] ELSE [192 | ({point} >> 6), 128 | ({point} & 63)] END))"
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {octets}), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))")


def op11_sql(fields: tuple, fan_out: int = 16) -> str:
    def leaf(text: str) -> str:
        values = [text if f == "text" else f"{f}::VARCHAR" for f in fields]
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v}))::VARCHAR || ':' || {v}, '-')" for v in values) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH RECURSIVE {CRC_TABLE},
    hashed AS MATERIALIZED (
        SELECT doc_id, source, {leaf("text")} AS leaf,
               CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS edited
        FROM documents, crc),
    leaves AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
               count(*) OVER (PARTITION BY source) AS total
        FROM hashed),
    grown AS (
        SELECT source, 0 AS level, pos, leaf AS node, total FROM leaves
        UNION ALL
        SELECT source, level + 1, pos // {fan_out}, sha256(string_agg(node, '' ORDER BY pos)), (any_value(total) + {fan_out - 1}) // {fan_out}
        FROM grown WHERE total > 1 GROUP BY source, level, pos // {fan_out}),
    inner_nodes AS MATERIALIZED (SELECT * FROM grown),
    subroots AS MATERIALIZED (
        SELECT source, level AS height, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
        FROM inner_nodes WHERE total = 1),
    topped AS (
        SELECT 0 AS level, place AS pos, subroot AS node, n AS total FROM subroots
        UNION ALL
        SELECT level + 1, pos // {fan_out}, sha256(string_agg(node, '' ORDER BY pos)), (any_value(total) + {fan_out - 1}) // {fan_out}
        FROM topped WHERE total > 1 GROUP BY level, pos // {fan_out}),
    upper_nodes AS MATERIALIZED (SELECT * FROM topped),
    sides AS MATERIALIZED (  -- what stands before and after each node in its run, numbered from the leaves on
        SELECT a.source, a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS after
        FROM inner_nodes a JOIN inner_nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.pos // {fan_out} = b.pos // {fan_out}
        WHERE a.total > 1 GROUP BY a.source, a.level, a.pos),
    upper_sides AS MATERIALIZED (
        SELECT a.level, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos < a.pos), '') AS before,
               coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (WHERE b.pos > a.pos), '') AS after
        FROM upper_nodes a JOIN upper_nodes b ON a.level = b.level AND a.pos // {fan_out} = b.pos // {fan_out}
        WHERE a.total > 1 GROUP BY a.level, a.pos),
    steps AS MATERIALIZED (
        SELECT source, pos AS leaf_pos, level, before, after FROM (
            SELECT l.source, l.pos, s.level, s.before, s.after FROM leaves l JOIN sides s
              ON l.source IS NOT DISTINCT FROM s.source AND s.pos = l.pos // ({fan_out} ** s.level)::BIGINT
            UNION ALL
            SELECT l.source, l.pos, r.height + u.level, u.before, u.after FROM leaves l
              JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source JOIN upper_sides u ON u.pos = r.place // ({fan_out} ** u.level)::BIGINT)),
    folds AS (
        SELECT source, pos, 0 AS level, edited AS node FROM leaves
        UNION ALL
        SELECT f.source, f.pos, f.level + 1, sha256(s.before || f.node || s.after)
        FROM folds f JOIN steps s ON f.source IS NOT DISTINCT FROM s.source AND f.pos = s.leaf_pos AND f.level = s.level),
    folded AS (SELECT source, pos, arg_max(node, level) AS folded_root FROM folds GROUP BY source, pos),
    proofs AS (SELECT source, leaf_pos AS pos, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY source, leaf_pos)
    SELECT doc_id, leaf, subroot, node AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = node AS verified
    FROM leaves l JOIN subroots r ON l.source IS NOT DISTINCT FROM r.source
    JOIN folded f ON l.source IS NOT DISTINCT FROM f.source AND l.pos = f.pos
    LEFT JOIN proofs p ON l.source IS NOT DISTINCT FROM p.source AND l.pos = p.pos,
    (SELECT node FROM upper_nodes WHERE total = 1) t"""


def op12_sql(drop_one_in: int, least_chars: int, least: int, ratio: int) -> str:
    return rf"""
    WITH RECURSIVE {CRC_TABLE},
    found AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
        FROM documents),
    runs AS MATERIALIZED (SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS n FROM found WHERE length(run) >= {least_chars} GROUP BY ALL),
    hashed AS (SELECT run, n, {crc32_sql("(id || ':' || run)")} AS h FROM runs, crc),
    cut AS (
        SELECT CASE WHEN h % {drop_one_in} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
        FROM hashed),
    words AS MATERIALIZED (
        SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {least_chars} GROUP BY word HAVING sum(n) >= {least}),
    holes AS MATERIALIZED (
        SELECT word, n, substr(word, 1, i::INT - 1) AS head, substr(word, i::INT + 1) AS tail
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
        UNION ALL SELECT DISTINCT a.word, b.word, b.n FROM words a JOIN holes b ON a.word = b.head || b.tail
        UNION ALL SELECT DISTINCT b.word, a.word, a.n FROM words a JOIN holes b ON a.word = b.head || b.tail),
    best AS MATERIALIZED (
        SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near
        FROM near),
    judged AS MATERIALIZED (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {ratio} * w.n THEN near END AS form,
               CASE WHEN near_n >= {ratio} * w.n THEN near_n END AS form_n
        FROM words w LEFT JOIN best b ON w.word = b.word AND place = 1),
    ways AS (
        SELECT word, word AS at FROM judged
        UNION ALL SELECT w.word, j.form FROM ways w JOIN judged j ON j.word = w.at WHERE j.form IS NOT NULL)
    SELECT j.word, j.form, w.at AS root, j.n, j.n_near, j.form_n
    FROM judged j JOIN ways w ON j.word = w.word JOIN judged e ON e.word = w.at WHERE e.form IS NULL"""
