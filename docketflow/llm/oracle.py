"""DuckDB SQL of the registered queries that SQL can express."""

# Levels of trees that the SQL goes through: 16 ** 6 rows of a source, 16 ** 4 sources.
_SOURCE_LEVELS, _TOP_LEVELS = 6, 4
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FIELDS = ("doc_id", "source", "lang", "n_chars")


def _leaf(text: str) -> str:
    """H of a row's fields in DuckDB."""
    parts = [f"CAST({name} AS VARCHAR)" for name in _FIELDS] + [text]
    return "sha256(" + " || ".join(
        f"coalesce(CAST(strlen({x}) AS VARCHAR) || ':' || {x}, '-')" for x in parts
    ) + ")"


def _tree(name: str, levels: int) -> str:
    """CTEs of the levels above ``{name}0(tree, idx, hash, n)`` and of the siblings at each."""
    run = "PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN"
    steps = []
    for k in range(levels):
        steps.append(f"""
        {name}_side{k} AS (
            SELECT tree, idx, n > 1 AS several,
                   coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name}{k}
        ),
        {name}{k + 1} AS (
            SELECT tree, idx // 16 AS idx, (max(n) + 15) // 16 AS n,
                   CASE WHEN max(n) > 1 THEN sha256(string_agg(hash, '' ORDER BY idx))
                        ELSE min(hash) END AS hash
            FROM {name}{k} GROUP BY tree, idx // 16
        ),""")
    return "".join(steps)


def _climb(name: str, levels: int, tree: str, idx: str, before: str) -> str:
    """CTEs that fold each row's hash and collect its siblings, level by level."""
    steps = []
    for k in range(levels):
        steps.append(f"""
        {name}_up{k} AS (
            SELECT b.* EXCLUDE (siblings, node),
                   CASE WHEN several THEN siblings || l || r ELSE siblings END AS siblings,
                   CASE WHEN several THEN sha256(l || node || r) ELSE node END AS node
            FROM {before} b JOIN {name}_side{k} s
              ON s.tree = b.{tree} AND s.idx = b.{idx} // {16**k}
        ),""")
        before = f"{name}_up{k}"
    return "".join(steps)


_MANIFEST = f"""
        WITH sources AS (
            SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS src
            FROM (SELECT DISTINCT source FROM documents)
        ),
        hashed AS (
            SELECT src, doc_id, {_leaf("text")} AS leaf, {_leaf(_LOWERED)} AS lowered,
                   CAST(doc_id AS VARCHAR) AS id
            FROM (SELECT d.*, src FROM documents d
                  JOIN sources s ON d.source IS NOT DISTINCT FROM s.source)
        ),
        leaves AS (
            SELECT src, doc_id, leaf,
                   -- the low bits of CRC-32, bit by bit over the bytes of the decimal id
                   CASE WHEN id IS NOT NULL AND xor(list_reduce(
                       list_transform(range(1, length(id) + 1), lambda i: CAST(ascii(id[i]) AS BIGINT)),
                       lambda c, b: list_reduce(
                           [0, 0, 0, 0, 0, 0, 0, 0],
                           lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END),
                           xor(c, b)),
                       4294967295), 4294967295) % 5 = 0
                       THEN lowered ELSE leaf END AS tampered,
                   row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                   count(*) OVER (PARTITION BY src) AS n
            FROM hashed
        ),
        t0 AS (SELECT src AS tree, idx, leaf AS hash, n FROM leaves),
        {_tree("t", _SOURCE_LEVELS)}
        u0 AS (
            SELECT 0 AS tree, tree AS idx, hash, count(*) OVER () AS n FROM t{_SOURCE_LEVELS}
        ),
        {_tree("u", _TOP_LEVELS)}
        started AS (SELECT *, 0 AS top, '' AS siblings, tampered AS node FROM leaves),
        {_climb("t", _SOURCE_LEVELS, "src", "idx", "started")}
        {_climb("u", _TOP_LEVELS, "top", "src", f"t_up{_SOURCE_LEVELS - 1}")}
        roots AS (SELECT hash AS root FROM u{_TOP_LEVELS})
        SELECT a.doc_id, a.leaf, t.hash AS subroot, root, sha256(siblings) AS proof_sha256,
               node AS folded_root, node = root AS verified
        FROM u_up{_TOP_LEVELS - 1} a, roots, t{_SOURCE_LEVELS} t WHERE t.tree = a.src
"""

ORACLE_SQL = {
    "op1_substring_dedup": r"""
        WITH words AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS ws
            FROM documents
        ),
        starts AS (
            SELECT r, unnest(range(1, len(ws) - 33)) AS i, ws FROM words WHERE len(ws) >= 35
        ),
        windows AS (SELECT r, i, array_to_string(ws[i : i + 34], ' ') AS w FROM starts),
        repeated AS (
            SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows)
            WHERE n > 1
        ),
        placed AS (
            SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM words
        ),
        judged AS (
            SELECT p.r, p.word, p.pos,
                   max(s.i) OVER (PARTITION BY p.r ORDER BY p.pos
                                  ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
            FROM placed p LEFT JOIN repeated s ON p.r = s.r AND p.pos = s.i
        ),
        kept AS (
            SELECT r, count(*) FILTER (WHERE gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS txt
            FROM judged GROUP BY r
        )
        SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
               coalesce(k.n_removed, 0) AS n_removed,
               sha256(coalesce(k.txt, '')) AS kept_sha256
        FROM words w LEFT JOIN kept k USING (r)
    """,
    "op5_exact_topk": """
        WITH vectors AS (
            SELECT vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(
                       list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM vectors q JOIN vectors c
              ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scored
        ) WHERE rank <= 5
    """,
    "op10_line_dedup": r"""
        WITH pages AS (SELECT row_number() OVER () AS r, * FROM documents),
        lines AS (
            SELECT r, source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM pages
        ),
        sizes AS (SELECT source, count(*) AS n_pages FROM pages GROUP BY source),
        boilerplate AS (
            SELECT l.source, list(l.line) AS gone FROM (
                SELECT source, line, count(*) AS n_with FROM lines
                WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')
                GROUP BY source, line HAVING count(*) >= 5
            ) l JOIN sizes s ON l.source IS NOT DISTINCT FROM s.source
            WHERE l.n_with > 0.1 * s.n_pages GROUP BY l.source
        ),
        cut AS (
            SELECT p.doc_id, p.source, p.text, string_split(p.text, chr(10)) AS ls,
                   coalesce(b.gone, []) AS gone
            FROM pages p LEFT JOIN boilerplate b ON p.source IS NOT DISTINCT FROM b.source
        )
        SELECT doc_id, source,
               CASE WHEN text IS NOT NULL THEN
                   array_to_string(list_filter(ls, lambda x: NOT list_contains(gone, x)), chr(10))
               END AS text,
               CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
               CAST(coalesce(len(ls) - len(list_filter(ls, lambda x: NOT list_contains(gone, x))), 0)
                    AS BIGINT) AS n_dropped
        FROM cut
    """,
    "op11_merkle_manifest": _MANIFEST,
    "op12_source_divergence": r"""
        WITH docs AS (
            SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   list_transform(
                       regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
                       lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                   ) AS ts
            FROM documents
        ),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        kept AS (
            SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM docs)
            GROUP BY lang, term HAVING count(*) >= 10
        ),
        sizes AS (SELECT g.lang, count(k.term) AS v
                  FROM (SELECT DISTINCT lang FROM groups) g LEFT JOIN kept k USING (lang) GROUP BY g.lang),
        uses AS (
            SELECT lang, source, term, count(*) AS c
            FROM (SELECT lang, source, unnest(ts) AS term FROM docs) JOIN kept USING (lang, term)
            GROUP BY lang, source, term
        ),
        full_counts AS (
            SELECT g.lang, g.source, k.term, coalesce(u.c, 0) AS c
            FROM groups g JOIN kept k USING (lang) LEFT JOIN uses u USING (lang, source, term)
        ),
        weighed AS (
            SELECT lang, source, term, c, 1 + CAST(1000000000 * CAST(c + 2 AS HUGEINT)
                       // (sum(c) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p
            FROM full_counts JOIN sizes USING (lang)
        ),
        whole AS (
            SELECT lang, term, 1 + CAST(1000000000 * CAST(c + 2 AS HUGEINT)
                       // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q
            FROM (SELECT lang, term, sum(c) AS c FROM full_counts GROUP BY lang, term)
            JOIN sizes USING (lang)
        ),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                   coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN weighed x ON x.lang = a.lang AND x.source = a.source
            LEFT JOIN weighed y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
            GROUP BY ALL
        ),
        terms AS (
            SELECT w.lang, w.source, 'term' AS part, w.term AS item,
                   (p - q) * (p - q) // (p + q) AS value
            FROM weighed w JOIN whole USING (lang, term) WHERE w.c > 0 AND p > q
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
        )
        WHERE part = 'pair' OR rank <= 10
    """,
}
