"""DuckDB SQL for the operators that SQL can state."""

# A-Z only, as the engine's default lower() would change other letters too.
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _url_filter() -> str:
    """Rules, page-weighted counts of one to five characters, and the
    interpolation n' = (n + kinds * shorter) / (context + kinds) written out
    from one character up to five; cut between the classes' means."""
    def longer(k: int) -> str:
        def p(c: str) -> str:
            return (f"CASE WHEN coalesce(x.m{c}, 0) = 0 THEN s.p{c} ELSE "
                    f"(coalesce(g.n{c}, 0) + x.t{c} * s.p{c}) / (x.m{c} + x.t{c}) END AS p{c}")
        return f"""s{k} AS (SELECT s.w, {p('a')}, {p('b')} FROM s{k - 1} s
                     LEFT JOIN grams g ON g.k = {k} AND g.g = right(s.w, {k})
                     LEFT JOIN contexts x ON x.k = {k} AND x.c = left(right(s.w, {k}), {k - 1}))"""
    return f"""
        WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                                           ELSE '' END AS rest FROM pages),
        parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
        rules(ruled, rule, name, start) AS (VALUES
            ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
            ('allow', 'www.example.com/en/', 'www.example.com', '/en/'),
            ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
        urls AS (SELECT host, path, count(*) AS pages FROM parts GROUP BY host, path),
        fits AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(ruled, length(rule)) AS ruled
                 FROM urls JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start)
                 GROUP BY host, path),
        judged AS (SELECT urls.*, rule, ruled FROM urls LEFT JOIN fits ON urls.host = fits.host AND urls.path = fits.path),
        windows AS (SELECT host, path, pages, ruled, substr('^^^^' || host || path || '$', i::BIGINT, 5) AS w
                    FROM judged, unnest(range(1, length(host || path) + 2)) AS u(i)),
        counts AS (SELECT w, coalesce(sum(pages) FILTER (ruled = 'allow'), 0) AS a,
                          coalesce(sum(pages) FILTER (ruled = 'block'), 0) AS b FROM windows GROUP BY w),
        grams AS (SELECT k, right(w, k::BIGINT) AS g, sum(a)::DOUBLE AS na, sum(b)::DOUBLE AS nb
                  FROM counts, unnest(range(1, 6)) AS u(k) GROUP BY ALL HAVING sum(a) + sum(b) > 0),
        contexts AS (SELECT k, left(g, k - 1) AS c, sum(na) AS ma, sum(nb) AS mb,
                            count(*) FILTER (na > 0) AS ta, count(*) FILTER (nb > 0) AS tb
                     FROM grams WHERE k > 1 GROUP BY ALL),
        total AS (SELECT sum(na) AS all_a, sum(nb) AS all_b, count(*) AS letters FROM grams WHERE k = 1),
        s1 AS (SELECT w, (coalesce(na, 0) + 1) / (all_a + letters + 1) AS pa, (coalesce(nb, 0) + 1) / (all_b + letters + 1) AS pb
               FROM counts CROSS JOIN total LEFT JOIN grams ON k = 1 AND g = right(w, 1)),
        {", ".join(longer(k) for k in range(2, 6))},
        scores AS (SELECT host, path, ruled, any_value(pages) AS pages, round(avg(ln(pa / pb)), 9) AS score
                   FROM windows JOIN s5 USING (w) GROUP BY host, path, ruled),
        side AS (SELECT ruled, sum(pages * score) / sum(pages) AS m, sum(pages * score * score) / sum(pages) AS q
                 FROM scores WHERE ruled IS NOT NULL GROUP BY ruled),
        pair AS (SELECT x.m AS ma, sqrt(greatest(0, x.q - x.m * x.m)) AS sa, y.m AS mb, sqrt(greatest(0, y.q - y.m * y.m)) AS sb
                 FROM side x, side y WHERE x.ruled = 'allow' AND y.ruled = 'block'),
        cut AS (SELECT round(CASE WHEN sa + sb > 0 THEN (ma * sb + mb * sa) / (sa + sb)
                                  ELSE (ma + mb) / 2 END, 6) AS cut FROM pair)
        SELECT page_id, host, path, rule,
               coalesce(judged.ruled, CASE WHEN cut IS NULL OR score >= cut THEN 'allow' ELSE 'block' END) AS verdict
        FROM parts JOIN judged USING (host, path) JOIN scores USING (host, path) LEFT JOIN cut ON true"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit: -1 stands for one shift."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) "
            "WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END), 4294967295)")


#: Tree levels that the SQL writes out; 16 ** 6 leaves a source and sources.
_MERKLE_LEVELS = 6


def _merkle() -> str:
    """Levels above the leaves, then above the subroots; per document the
    others of its run on every level."""
    def leaf(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in fields) + ")"

    steps = [f"""docs AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS g, {leaf('text')} AS leaf,
                   CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS hit
                   FROM documents)""",
             """placed AS (SELECT doc_id, g, leaf, coalesce(hit, leaf) AS found,
                   row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs)""",
             "a0 AS (SELECT g, pos, leaf AS digest, count(*) OVER (PARTITION BY g) AS c FROM placed)"]

    def level(name, k):
        steps.append(f"""{name}{k} AS (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM (
            SELECT g, pos // 16 AS pos, CASE WHEN max(c) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE max(digest) END AS digest
            FROM {name}{k - 1} GROUP BY g, pos // 16))""")

    def climb(before, after, name, k):
        """A document's siblings on a level, and its digest folded through them."""
        steps.append(f"""{after} AS (SELECT p.id, any_value(p.g) AS g, any_value(p.pos) // 16 AS pos,
            any_value(p.proof) || CASE WHEN max(n.c) > 1 THEN coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos <> p.pos), '') ELSE '' END AS proof,
            CASE WHEN max(n.c) > 1 THEN sha256(coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos < p.pos), '') || any_value(p.acc)
                 || coalesce(string_agg(n.digest, '' ORDER BY n.pos) FILTER (n.pos > p.pos), '')) ELSE any_value(p.acc) END AS acc
            FROM {before} p JOIN {name}{k} n ON n.g = p.g AND n.pos // 16 = p.pos // 16 GROUP BY p.id)""")

    for k in range(1, _MERKLE_LEVELS + 1):
        level("a", k)
    steps.append(f"b0 AS (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, digest, count(*) OVER () AS c, g AS tree FROM a{_MERKLE_LEVELS})")
    for k in range(1, _MERKLE_LEVELS + 1):
        level("b", k)
    steps.append("p0 AS (SELECT row_number() OVER () AS id, *, '' AS proof, found AS acc FROM placed)")
    for k in range(_MERKLE_LEVELS):
        climb(f"p{k}", f"p{k + 1}", "a", k)
    steps.append(f"q0 AS (SELECT p.id, '' AS g, b0.pos, p.proof, p.acc FROM p{_MERKLE_LEVELS} p JOIN b0 ON b0.tree = p.g)")
    for k in range(_MERKLE_LEVELS):
        climb(f"q{k}", f"q{k + 1}", "b", k)
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, leaf, b0.digest AS subroot, r.digest AS root, sha256(q.proof) AS proof_sha256, q.acc AS folded_root,
               q.acc = r.digest AS verified
        FROM p0 JOIN q{_MERKLE_LEVELS} q USING (id) JOIN b0 ON b0.tree = p0.g, b{_MERKLE_LEVELS} r"""


ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": f"""
        WITH n AS (SELECT doc_id, {_ASCII_LOWER} AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM n JOIN g USING (t)""",
    "op8_url_filter": _url_filter(),
    "op11_merkle_manifest": _merkle(),
    "op12_prefix_trie": f"""
        WITH turns AS (SELECT conv_id, turn, coalesce(text, '') AS text,
                              substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest
                       FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list({{'d': digest, 'b': strlen(text)}} ORDER BY turn NULLS FIRST, digest) AS t,
                       {crc32_sql('conv_id::VARCHAR')} % 9 AS h FROM turns GROUP BY conv_id),
        whole AS (SELECT o.conv_id, coalesce(f.t[1:o.h], []) || o.t[o.h + 1:] AS t
                  FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 5),
        steps AS (SELECT conv_id, len(t) AS n, d, array_to_string(list_transform(t[1:d], lambda x: x['d']), '') AS k,
                         CASE WHEN d = 0 THEN 0 ELSE t[d]['b'] END AS b
                  FROM whole, unnest(range(0, len(t) + 1)) AS u(d)),
        nodes AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b,
                         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends
                  FROM steps GROUP BY d, k),
        children AS (SELECT d - 1 AS d, substr(k, 1, 32 * (d - 1)) AS k, count(*) AS c FROM nodes WHERE d > 0 GROUP BY ALL),
        counted AS (SELECT nodes.*, coalesce(c, 0) AS c FROM nodes LEFT JOIN children USING (d, k)),
        below AS (SELECT a AS d, substr(k, 1, 32 * a) AS k, count(*) FILTER (c = 0) AS leaves, sum((n_convs - 1) * b) AS saved
                  FROM counted, unnest(range(0, d + 1)) AS u(a) GROUP BY ALL)
        SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.c AS n_children, leaves AS n_leaves,
               saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
        FROM counted n JOIN below USING (d, k)
             LEFT JOIN nodes p ON p.d = n.d - 1 AND p.k = substr(n.k, 1, 32 * (n.d - 1))""",
}
