"""DuckDB SQL twins of the derived fixtures and of the text predicates.

``with_views(names, body)`` prefixes ``body`` with the CTEs it needs, resolving
dependencies, so each oracle query is one self-contained statement over the
pre-registered driver tables. RE2 character classes are explicit ranges.
"""
from __future__ import annotations

from parley.plans.fixtures import LETTERS, LINE_BASE, PSEUDO_CJK

# Fixed value: the Python whitespace set written as an RE2 class.
WS = ("[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
INJECTED_WS_SQL = "(chr(9) || chr(12288) || chr(160) || ' ')"


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def has_cjk(x: str) -> str:
    return f"regexp_matches({x}, '[一-鿿]')"


def punct_only(x: str) -> str:
    return f"(NOT regexp_matches(coalesce({x}, ''), '[\\pL\\pN]'))"


def word_list(x: str) -> str:
    return f"list_filter(string_split({norm(x)}, ' '), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"len({word_list(x)})"


def codepoints(x: str) -> str:
    """Code point ids of a string; empty string gives an empty list."""
    return (f"(CASE WHEN length({x}) = 0 THEN []::INTEGER[] ELSE "
            f"list_transform(string_split({x}, ''), lambda c: CAST(unicode(c) AS INTEGER)) END)")


def keep_pred(a: str, b: str, min_len: int = 1, max_len: int = 200, max_ratio: float = 4.0) -> str:
    la, lb = f"length({a})", f"length({b})"
    return (f"coalesce(({la} > 0 AND {lb} > 0 AND {la} BETWEEN {min_len} AND {max_len} "
            f"AND {lb} BETWEEN {min_len} AND {max_len} "
            f"AND greatest({la}, {lb}) / greatest(1, least({la}, {lb})) <= {float(max_ratio)}), false)")


VIEWS: dict[str, tuple[list[str], str]] = {
    "pairs_clean": ([], f"""
        SELECT d.doc_id, CAST(t.o - 1 AS INTEGER) AS line_no, d.lang, d.source, t.v AS en,
               translate(lower(replace(t.v, ' ', '')), '{LETTERS}', '{PSEUDO_CJK}') AS zh
        FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS t(v, o)"""),
    "pairs_dirty": (["pairs_clean"], f"""
        SELECT doc_id, line_no, lang, source,
               CASE WHEN r = 3 THEN zh
                    WHEN r = 5 THEN {INJECTED_WS_SQL} || en || {INJECTED_WS_SQL} || 'x'
                    ELSE en END AS en,
               CASE WHEN r = 0 THEN '' WHEN r = 1 THEN '...!?' WHEN r = 2 THEN en
                    WHEN r = 4 THEN substr(zh, 1, 1) WHEN r = 6 THEN zh || zh || zh || zh || zh
                    ELSE zh END AS zh
        FROM (SELECT *, (doc_id * 31 + line_no) % 23 AS r FROM pairs_clean)"""),
    "directed_dirty": (["pairs_dirty"], f"""
        SELECT doc_id * {LINE_BASE} + line_no AS ex_id, zh AS src, en AS tgt, 'zh2en' AS direction FROM pairs_dirty
        UNION ALL
        SELECT doc_id * {LINE_BASE} + line_no AS ex_id, en AS src, zh AS tgt, 'en2zh' AS direction FROM pairs_dirty"""),
    "directed_clean": (["pairs_clean"], f"""
        SELECT doc_id * {LINE_BASE} + line_no AS ex_id, zh AS src, en AS tgt, 'zh2en' AS direction FROM pairs_clean
        UNION ALL
        SELECT doc_id * {LINE_BASE} + line_no AS ex_id, en AS src, zh AS tgt, 'en2zh' AS direction FROM pairs_clean"""),
    # corpus as built: PF1 + PF3 on (zh, en) over the dirty pairs, then PF5
    "accepted": (["pairs_dirty"], f"""
        SELECT * FROM (SELECT doc_id, line_no, lang, source, {norm('en')} AS en, {norm('zh')} AS zh FROM pairs_dirty)
        WHERE {keep_pred('zh', 'en')}"""),
    "built": (["accepted"], f"""
        SELECT doc_id * {LINE_BASE} + line_no AS ex_id, zh AS src, en AS tgt, 'zh2en' AS direction FROM accepted
        UNION ALL
        SELECT doc_id * {LINE_BASE} + line_no AS ex_id, en AS src, zh AS tgt, 'en2zh' AS direction FROM accepted"""),
    "sources": ([], """
        SELECT source, CASE WHEN TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 2 = 0
                            THEN 'spoken' ELSE 'general' END AS kind
        FROM (SELECT DISTINCT source FROM documents)"""),
    "conv_pairs": ([], """
        SELECT u.conv_id, u.turn, u.text AS src, a.text AS tgt
        FROM conversations u JOIN conversations a
          ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        WHERE u.role = 'user'"""),
}


def with_views(names: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in MATERIALIZED else ''}({VIEWS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


MATERIALIZED: set[str] = set()


def add_view(name: str, deps: list[str], sql: str, materialized: bool = False) -> None:
    VIEWS[name] = (deps, sql)
    if materialized:
        MATERIALIZED.add(name)


add_view("next_vectors", [], """
    SELECT vec_id, coalesce(lead(vec_id) OVER (ORDER BY vec_id), min(vec_id) OVER ()) AS next_id FROM embeddings""")
