"""DuckDB SQL for the queries that SQL can express."""

SQL: dict[str, str] = {}

# Words, lines and 8-word windows of the whole texts; lines counted by host over distinct texts.
SQL["op6_quality_rules"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS p FROM words WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows) WHERE c > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p + o) AS n FROM twice, (SELECT unnest(generate_series(0, 7)) AS o) GROUP BY doc_id
), raw_lines AS (
  SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS l FROM docs
), lines AS (
  SELECT doc_id, host, t, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS w
  FROM raw_lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), normal AS (
  SELECT doc_id, host, t, len(w) AS n,
         translate(array_to_string(w, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line
  FROM lines
), frequent AS (
  SELECT host, line FROM normal WHERE n <= 20 GROUP BY host, line HAVING count(DISTINCT t) > 20
), removed AS (
  SELECT doc_id, count(*) AS lines, sum(n) AS words FROM normal JOIN frequent USING (host, line) GROUP BY doc_id
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id
), s AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(repeated.n, 0)::BIGINT AS n_repeat_words,
         coalesce(removed.lines, 0)::BIGINT AS n_removed_lines,
         (len(w) - coalesce(removed.words, 0))::BIGINT AS n_left_words
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_lines, n_left_words,
       NOT base_failed AND n_left_words >= 8 AND n_left_words >= 0.4 * n_words AS kept
FROM b
"""

# Rules by longest text, else addresses that two pages or more share.
SQL["op7_url_filters"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
         max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY page_id
), shared AS (
  SELECT host, path FROM p WHERE host <> '' GROUP BY host, path HAVING count(*) >= 2
)
SELECT p.page_id, p.host, p.path, f.rule, shared.host IS NOT NULL AS listed_address,
       coalesce(f.verdict, CASE WHEN shared.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits f USING (page_id) LEFT JOIN shared ON p.host = shared.host AND p.path = shared.path
"""

# Revisits by equal payloads; DuckDB has no base32, so the digest's bits are spelled out.
SQL["op9_warc"] = r"""
WITH d AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), bits AS (
  SELECT page_id, array_to_string(list_transform(string_split(h, ''),
           lambda c: lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0')), '') AS b FROM d
), digests AS (
  SELECT page_id, array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           16 * (substr(b, 5 * i + 1, 1) = '1')::INT + 8 * (substr(b, 5 * i + 2, 1) = '1')::INT
           + 4 * (substr(b, 5 * i + 3, 1) = '1')::INT + 2 * (substr(b, 5 * i + 4, 1) = '1')::INT
           + (substr(b, 5 * i + 5, 1) = '1')::INT + 1, 1)), '') AS payload_digest FROM bits
), first AS (
  SELECT h, min(page_id) AS page FROM d GROUP BY h
)
SELECT d.page_id, d.payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN d.page_id = first.page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id = first.page THEN NULL ELSE first.page END AS refers_to
FROM d JOIN digests USING (page_id) JOIN first USING (h)
"""


def _crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes (``crc.t`` is the table of byte remainders)."""
    codes = (f"list_transform(generate_series(0, strlen({text}) - 1), "
             f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            f"lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


def _crc_table() -> str:
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384::BIGINT) ELSE {0} >> 1 END"   # the reflected polynomial
    t = "generate_series(0::BIGINT, 255::BIGINT)"
    for _ in range(8):
        t = f"list_transform({t}, lambda c: {step.format('c')})"
    return f"crc AS MATERIALIZED (SELECT {t} AS t)"


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Near words by what is left without one code point; forms followed by recursion.
SQL["op11_spelling"] = f"""
WITH RECURSIVE {_crc_table()}, runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT run, k, {_crc32("(doc_id::VARCHAR || ':' || run)")} AS h FROM runs, crc
), misspelt AS (
  SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
  FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM misspelt WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
), places AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM words)
), close AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM places x JOIN places y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM places x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word, x.n FROM places x JOIN words y ON x.a || x.b = y.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS form, max(n) AS form_n FROM close GROUP BY word
), forms AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
         CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON walk.at = forms.word WHERE forms.form IS NOT NULL
)
SELECT forms.word, forms.form, walk.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN walk USING (word) JOIN forms ends ON walk.at = ends.word WHERE ends.form IS NULL
"""

SQL["op12_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""


def _climb(name: str, tree: str, levels: int) -> str:
    """CTEs of one forest: ``{name}0`` (tree, pos, d, n) grouped by threes, level by level; a tree with one node stays."""
    out = []
    for k in range(levels):
        out.append(f"""
{name}_run{k} AS MATERIALIZED (
  SELECT {tree}, pos // 3 AS run, n, list(d ORDER BY pos) AS ds FROM {name}{k} GROUP BY {tree}, pos // 3, n
), {name}{k + 1} AS MATERIALIZED (
  SELECT {tree}, run AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, (n + 2) // 3 AS n
  FROM {name}_run{k}
)""")
    return ",".join(out)


def _fold(start: str, name: str, tree: str, levels: int) -> str:
    """CTEs that take ``{start}`` (doc_id, tree, pos, node, proof, ...) to the top of its tree in the forest ``name``."""
    out, before = [], start
    for k in range(levels):
        left, right = "array_to_string(ds[1:p % 3], '')", "array_to_string(ds[p % 3 + 2:], '')"
        out.append(f"""
{name}_fold{k} AS MATERIALIZED (
  SELECT c.* REPLACE (c.p // 3 AS p, CASE WHEN r.n > 1 THEN sha256({left} || node || {right}) ELSE node END AS node,
                      CASE WHEN r.n > 1 THEN proof || {left} || {right} ELSE proof END AS proof)
  FROM {before} c JOIN {name}_run{k} r ON c.{tree} = r.{tree} AND c.p // 3 = r.run
)""")
        before = f"{name}_fold{k}"
    return ",".join(out)


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in
              ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
    return f"sha256({' || '.join(fields)})"


# Levels are written out: up to 3 ** 11 documents a source and 3 ** 6 sources.
SQL["op13_merkle_manifest"] = f"""
WITH {_crc_table()}, rows AS MATERIALIZED (
  SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS altered
  FROM documents, crc
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS p, count(*) OVER (PARTITION BY tree) AS n FROM rows
), s0 AS (SELECT tree, p AS pos, leaf AS d, n FROM placed), {_climb("s", "tree", 11)}, subroots AS MATERIALIZED (
  SELECT tree, d AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM s11
), t0 AS (SELECT 1 AS one, pos, subroot AS d, n FROM subroots), {_climb("t", "one", 6)}, begun AS (
  SELECT doc_id, tree, leaf, p, altered AS node, '' AS proof FROM placed
), {_fold("begun", "s", "tree", 11)}, between AS (
  SELECT f.* REPLACE (u.pos AS p), 1 AS one, u.subroot FROM s_fold10 f JOIN subroots u USING (tree)
), {_fold("between", "t", "one", 6)}
SELECT f.doc_id, f.leaf, f.subroot, t6.d AS root, sha256(f.proof) AS proof_sha256, f.node AS folded_root, f.node = t6.d AS verified
FROM t_fold5 f JOIN t6 USING (one)
"""

# All pairs by shared shingles (whole texts), then the smallest id in reach.
SQL["op5_near_dedup"] = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS p FROM words)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id) p
  JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * c >= 75 * (m.n + n.n - c)
), reach AS (
  SELECT doc_id, doc_id AS r FROM words UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""
