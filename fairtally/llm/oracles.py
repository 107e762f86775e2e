"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

_HOST = "translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1)"
_RULE = """CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END"""
_BLOCKS = "('example.com/en/', 'net/es/', 'net/fr/')"


def _node(url: str) -> str:
    plain = f"regexp_replace(trim({url}), '(?s)#.*$', '')"
    start = f"regexp_extract({plain}, '(?s)^([^:/?#]+://[^/?#]*)', 1)"
    return (
        f"translate({start}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        f" || substr({plain}, length({start}) + 1)"
    )


def _rest(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://(.*)$', 1), '')"


def _joined(base: str, target: str) -> str:
    site = f"regexp_extract({base}, '(?s)^([^:/?#]+://[^/?#]*)', 1)"
    plain = f"regexp_extract({base}, '(?s)^([^?#]*)', 1)"
    folder = f"coalesce(nullif(regexp_extract({plain}, '(?s)^[^:/?#]+://[^/]*(/.*/|/)', 1), ''), '/')"
    return f"""CASE WHEN regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {target}
    WHEN regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*:|^#|^$') OR {site} = '' THEN NULL
    WHEN starts_with({target}, '//') THEN regexp_extract({base}, '(?s)^([^:/?#]+:)//', 1) || {target}
    WHEN starts_with({target}, '/') THEN {site} || {target} WHEN starts_with({target}, '?') THEN {plain} || {target}
    ELSE {site} || {folder} || {target} END"""


OP2 = f"""
WITH RECURSIVE tags AS (
  SELECT url AS u, regexp_replace(regexp_extract(html, '(?is)<base\\b[^>]*?[\\s"'']href\\s*=\\s*["'']?([^"''\\s>]+)', 1), '(?i)&amp;', '&', 'g') AS own_base,
    unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages
  WHERE regexp_matches(html, '(?i)canonical|http-equiv')),
raw AS (SELECT u, own_base, CASE
    WHEN regexp_matches(tag, '(?is)^<link\\b') AND list_contains(string_split(translate(lower(
        regexp_extract(tag, '(?is)[\\s"'']rel\\s*=\\s*("[^"]*"|''[^'']*''|[^"''\\s/>]+)', 1)), chr(9) || chr(10) || chr(13) || chr(34) || chr(39), '     '), ' '), 'canonical')
      THEN regexp_extract(tag, '(?is)[\\s"'']href\\s*=\\s*["'']?([^"''\\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\\b.*\\bhttp-equiv\\s*=\\s*["'']?refresh\\b') THEN regexp_extract(tag, '(?is)\\burl\\s*=\\s*["'']?([^"''\\s>;]+)', 1)
    ELSE '' END AS t FROM tags),
based AS (SELECT u, coalesce({_joined("u", "own_base")}, u) AS base, regexp_replace(t, '(?i)&amp;', '&', 'g') AS t FROM raw WHERE t <> ''),
dotted AS (SELECT DISTINCT u, regexp_extract(j, '(?s)^([^:/?#]+://[^/?#]*)', 1) AS site,
    regexp_extract(j, '(?s)^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(j, '(?s)^[^?#]*(.*)$', 1) AS tail
  FROM (SELECT u, {_joined("base", "t")} AS j FROM based) WHERE j IS NOT NULL),
shorter(u, site, path, tail) AS (SELECT * FROM dotted UNION ALL SELECT u, site, CASE WHEN regexp_matches(path, '/\\.(/|$)')
      THEN regexp_replace(path, '/\\.(/|$)', '/') ELSE regexp_replace(path, '^/\\.\\.(/|$)|/[^/]*/\\.\\.(/|$)', '/') END, tail
  FROM shorter WHERE regexp_matches(path, '/\\.\\.?(/|$)')),
targets AS (SELECT u, site || path || tail AS target FROM shorter WHERE NOT regexp_matches(path, '/\\.\\.?(/|$)')),
links AS (SELECT DISTINCT {_node("u")} AS a, {_node("target")} AS b FROM targets WHERE target IS NOT NULL AND u IS NOT NULL),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, a FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
ends AS (SELECT b, {_HOST} AS host, {_PATH} AS path FROM (SELECT DISTINCT b, {_rest("b")} AS rest FROM reach)),
bad AS (SELECT DISTINCT r.a FROM reach r JOIN ends e ON r.b = e.b WHERE {_RULE} IN {_BLOCKS}),
parts AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path, node
  FROM (SELECT page_id, {_rest("url")} AS rest, {_node("url")} AS node FROM pages)),
ruled AS (SELECT *, {_RULE} AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN {_BLOCKS} THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN node IN (SELECT a FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

OP4 = """
WITH p AS (SELECT CAST(page_id AS BIGINT) AS page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < original THEN original END AS refers_to
FROM m
"""

# crc32 by its definition, bit by bit: the reversed polynomial is the fixed value 0xEDB88320.
_CRC_TABLE = """crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
  FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text; the table is the only row of ``crc``."""
    codes = f"list_transform(CASE WHEN {text} = '' THEN [] ELSE string_split({text}, '') END, lambda c: ascii(c)::BIGINT)"
    step = "lambda a, b: xor(a >> 8, crc.t[xor(a, b) % 256 + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {step}), 4294967295)"


def _framed(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _merkle(levels: int = 6, top_levels: int = 4) -> str:
    """All nodes of a level from those below; then every leaf climbs level by level. 16 ** levels rows at most."""
    leaf = lambda text: "sha256(" + " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        _CRC_TABLE,
        f"""d AS MATERIALIZED (SELECT doc_id, source, {leaf("text")} AS leaf,
  CASE WHEN {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 5 = 0 THEN {leaf(low)} END AS tampered FROM documents, crc)""",
        """l AS MATERIALIZED (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM d)""",
        "n0 AS (SELECT tree, idx, n, leaf AS digest FROM l)",
    ]

    def climb(name: str, count: int) -> None:
        for k in range(count):
            parts.append(
                f"""{name}r{k} AS MATERIALIZED (SELECT tree, idx // 16 AS up, n, string_agg(digest, '' ORDER BY idx) AS run
  FROM {name}{k} GROUP BY tree, idx // 16, n)"""
            )
            parts.append(
                f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, up AS idx, (n + 15) // 16 AS n,
  CASE WHEN n > 1 THEN sha256(run) ELSE run END AS digest FROM {name}r{k})"""
            )

    climb("n", levels)
    parts.append(f"t0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, digest FROM n{levels})")
    climb("t", top_levels)
    parts.append(f"""w0 AS (SELECT l.doc_id, l.leaf, l.tree, l.idx, coalesce(l.tampered, l.leaf) AS f, '' AS sib,
  s.digest AS subroot, r.digest AS root FROM l JOIN n{levels} s ON s.tree = l.tree CROSS JOIN t{top_levels} r)""")
    done = 0

    def fold(name: str, count: int, tree: str, at: str) -> None:
        nonlocal done
        for k in range(count):
            i = f"(({at}) // {16**k})"
            before, after = f"substr(r.run, 1, 64 * ({i} % 16))", f"substr(r.run, 64 * ({i} % 16) + 65)"
            parts.append(
                f"""w{done + 1} AS (SELECT w.* REPLACE (CASE WHEN r.n > 1 THEN sha256({before} || w.f || {after}) ELSE w.f END AS f,
  w.sib || {before} || {after} AS sib) FROM w{done} w JOIN {name}r{k} r ON r.tree = {tree} AND r.up = {i} // 16)"""
            )
            done += 1

    fold("n", levels, "w.tree", "w.idx")
    fold("t", top_levels, "0", "w.tree")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, f AS folded_root, f = root AS verified FROM w{done}"
    )


OP12 = _merkle()


def _repair() -> str:
    """All states of all conversations row by row: the least (cost, audit) by dynamic programming.

    A state is a struct (c: cost, a: audit, t: repaired lines), null where it can't be reached.
    """
    fault = _crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')") + " % 20"
    go = lambda s, c, e, line: (
        f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {c}, 'a': {s}.a || '{e}', 't': {s}.t || {line}}} END"
    )
    gone = lambda s: go(s, 2, "D", "[]::VARCHAR[]")
    extra = "CASE WHEN r.truncated THEN 5 ELSE 0 END"

    def row(s: str, initial: str, role: str) -> str:
        """Keep or rerole after state s."""
        kept = f"CASE WHEN r.i = '{initial}' THEN {go(s, extra, 'K', "[r.role || ':' || r.text]")} END"
        return f"CASE WHEN NOT r.gone THEN list_min([{kept}, {go(s, f'1 + {extra}', 'R', f"['{role}:' || r.text]")}]) END"

    first = f"CASE WHEN NOT r.gone AND r.i = 's' THEN {go('f.z', extra, 'K', "[r.role || ':' || r.text]")} END"
    step = {
        "z": gone("f.z"),
        "s": f"list_min([{gone('f.s')}, {first}])",
        "u": f"list_min([{gone('f.u')}, {row('f.z', 'u', 'user')}, {row('f.s', 'u', 'user')}, {row('f.a', 'u', 'user')}])",
        "a": f"list_min([{gone('f.a')}, {row('f.u', 'a', 'assistant')}])",
    }
    # One insertion after a row, then one more; a third would come back to where it was.
    insert_u = lambda t: f"list_min([{t}.u, {go(f'{t}.z', 5, 'I', "['user:']")}, {go(f'{t}.s', 5, 'I', "['user:']")}, {go(f'{t}.a', 5, 'I', "['user:']")}])"
    insert_a = lambda t: f"list_min([{t}.a, {go(f'{t}.u', 5, 'I', "['assistant:']")}])"
    null = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR[]))"
    return f"""
WITH RECURSIVE {_CRC_TABLE},
raw AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {fault} AS v FROM conversations, crc),
bad AS (SELECT conv_id, turn, CASE WHEN v = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN v = 1 THEN '' WHEN v = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN v = 3 THEN [1, 2] ELSE [1] END) AS copy FROM raw WHERE v <> 0),
placed AS (SELECT *, left(role, 1) AS i,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(role || ':' || text), copy) AS k FROM bad),
marked AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS again,
    NOT regexp_matches(text, '(?s)[.!?][\x20\x09-\x0D]*$') AS cut,
    lag(i) OVER (PARTITION BY conv_id ORDER BY k) || i AS pair FROM placed),
r AS MATERIALIZED (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND cut AS truncated FROM marked),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
f AS (
  SELECT conv_id, 0::BIGINT AS k, CAST({{'c': 0, 'a': '', 't': []}} AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])) AS z, {null} AS s,
    CAST({{'c': 5, 'a': 'I', 't': ['user:']}} AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])) AS u,
    CAST({{'c': 10, 'a': 'II', 't': ['user:', 'assistant:']}} AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])) AS a FROM facts
  UNION ALL
  SELECT conv_id, k, z, s, u, {insert_a("q")} AS a FROM (
    SELECT conv_id, k, z, s, {insert_u("p")} AS u, a FROM (
      SELECT f.conv_id, f.k + 1 AS k, {step["z"]} AS z, {step["s"]} AS s, {step["u"]} AS u, {step["a"]} AS a
      FROM f JOIN r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.k = f.k + 1) p) q),
ends AS (SELECT f.conv_id, list_min([f.z, f.a]) AS best FROM f JOIN facts ON facts.conv_id IS NOT DISTINCT FROM f.conv_id AND f.k = facts.n),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


OP11 = _repair()

ORACLES = {"op2_url_filters": OP2, "op4_warc": OP4, "op11_structure_repair": OP11, "op12_merkle": OP12}
