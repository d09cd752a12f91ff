"""DuckDB SQL for the queries that SQL can express, over the whole tables."""
from __future__ import annotations

SQL: dict[str, str] = {}

_WORDS = r"[x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']"

SQL["op2_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS win FROM s),
o AS (SELECT win, min(doc_id) AS first FROM h GROUP BY win HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT h.doc_id, i FROM h JOIN o USING (win) WHERE h.doc_id > o.first),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM hit) GROUP BY doc_id),
pos AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (SELECT pos.doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM pos
         ANTI JOIN (SELECT doc_id, unnest(ps) AS p FROM gone) g ON g.doc_id = pos.doc_id AND g.p = pos.p GROUP BY pos.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_TERMS = r"[x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']"

SQL["op3_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_TERMS} AS w FROM benchmark),
bw AS (SELECT item, w[i:i + 9] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
bk AS (SELECT len(win) AS n, array_to_string(win, ' ') AS k, list(DISTINCT item) AS items FROM bw GROUP BY ALL),
sizes AS (SELECT DISTINCT n FROM bk),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
       SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dw.n, items FROM dw JOIN bk ON dw.n = bk.n AND dw.k = bk.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, list_sort(list(DISTINCT x)) AS l FROM (SELECT doc_id, unnest(items) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(l), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(l, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

SQL["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, regexp_replace(regexp_replace(url, '#.*$', '', 's'), '^.*?://', '', 's') AS rest FROM pages),
k AS (SELECT *, regexp_extract(rest, '^[^/?]*') AS host FROM p),
u AS (SELECT *, coalesce(array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www[.]', ''), '.')), ',') || ')'
                         || coalesce(nullif(substr(rest, length(host) + 1), ''), '/'), '-') AS urlkey FROM k),
q AS (SELECT page_id, urlkey, row_number() OVER (ORDER BY urlkey, page_id) - 1 AS history_pos, strlen(h)::BIGINT AS payload_bytes, upper(sha1(h)) AS hex, max(page_id) OVER (PARTITION BY h) AS newest FROM u)
SELECT page_id, payload_bytes, urlkey, history_pos,
       array_to_string(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((('0x' || hex[(i // 4) * 5 + 1:(i // 4) * 5 + 5])::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1]
                        for i in range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM q"""

_HASHED = r"CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0} END"
_ROW = " || ".join(_HASHED.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(list_reduce(flatten([[ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')]),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT), 4294967295)"""


def _tree(name: str, levels: int) -> str:
    """CTEs of a tree over ``name``0 (t, n, r, h): nodes ``name``j and runs ``name``_run_j of each level."""
    return ",".join(f"""
{name}{j} AS (SELECT t, n, r // 16 AS r, sha256(string_agg(h, '' ORDER BY r)) AS h FROM {name}{j - 1} WHERE n > {16 ** (j - 1)} GROUP BY t, n, r // 16),
{name}_run_{j} AS (SELECT t, r // 16 AS g, list(h ORDER BY r) AS run FROM {name}{j - 1} WHERE n > {16 ** (j - 1)} GROUP BY t, r // 16)"""
                    for j in range(1, levels + 1)) + f""",
{name}_top AS ({" UNION ALL ".join(f"SELECT t, h FROM {name}{j} WHERE n <= {16 ** j} AND n > {16 ** (j - 1) if j else 0}" for j in range(levels + 1))})"""


def _step(prev: str, name: str, tree: str, rank: str, level: int, run: str) -> str:
    """A CTE that folds one level into the proof and the root of ``prev``."""
    at = f"({rank} // {16 ** (level - 1)}) % 16"
    left, right = f"array_to_string(run[1:{at}], '')", f"array_to_string(run[{at} + 2:], '')"
    return f"""
{name} AS (SELECT p.* EXCLUDE (proof, f), proof || coalesce({left} || {right}, '') AS proof,
  CASE WHEN run IS NULL THEN f ELSE sha256({left} || f || {right}) END AS f
  FROM {prev} p LEFT JOIN {run} q ON q.t = {tree} AND q.g = {rank} // {16 ** level})"""


def _merkle(levels: int = 6) -> str:
    steps, prev = [], "f0"
    for k, (tree, rank, runs) in enumerate((("p.t", "p.r", "d"), ("0", "p.t", "s"))):
        for j in range(1, levels + 1):
            name = f"f{k * levels + j}"
            steps.append(_step(prev, name, tree, rank, j, f"{runs}_run_{j}"))
            prev = name
    return f"""
WITH l AS (SELECT doc_id, source, sha256({_ROW} || {_HASHED.format("text")}) AS leaf,
  CASE WHEN {_CRC} % 5 = 0 THEN sha256({_ROW} || {_HASHED.format(_LOWERED)}) END AS bad FROM documents),
g AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS t FROM l GROUP BY source),
x AS (SELECT l.*, g.t, g.n, row_number() OVER (PARTITION BY g.t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
      FROM l JOIN g ON l.source IS NOT DISTINCT FROM g.source),
d0 AS (SELECT t, n, r, leaf AS h FROM x),{_tree("d", levels)},
s0 AS (SELECT 0 AS t, (SELECT count(*) FROM g) AS n, t AS r, h FROM d_top),{_tree("s", levels)},
f0 AS (SELECT doc_id, leaf, t, r, '' AS proof, coalesce(bad, leaf) AS f FROM x),{",".join(steps)}
SELECT doc_id, leaf, d_top.h AS subroot, s_top.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = s_top.h AS verified
FROM {prev} p JOIN d_top ON d_top.t = p.t, s_top"""


SQL["op11_merkle"] = _merkle()


def _collocations(sizes: int = 5, threshold: int = 100, top: int = 2000) -> str:
    grams = " UNION ALL ".join(f"SELECT lang, {m} AS size, array_to_string(w[i:i + {m - 1}], ' ') AS phrase FROM "
                               f"(SELECT lang, w, unnest(range(1, len(w) - {m - 2})) AS i FROM p WHERE len(w) >= {m})" for m in range(1, sizes + 1))
    return rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, [x for x in string_split_regex(piece, '[\x20\x09]+') if x <> ''] AS w FROM t),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
f AS (SELECT lang, size, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {threshold}),
c AS (SELECT lang, phrase, f AS a, size, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
cut AS (SELECT k.lang, k.phrase, a, k, x.f AS l, y.f AS r, n, (1000 * a::HUGEINT * n) // (x.f::HUGEINT * y.f) AS score FROM k
        JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
        JOIN total ON total.lang = k.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
sub AS (SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, a, w, unnest(range(2, size)) AS m FROM c WHERE size > 2)),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM sub GROUP BY ALL),
left_over AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM left_over QUALIFY rank <= {top}"""


SQL["op12_collocations"] = _collocations()
