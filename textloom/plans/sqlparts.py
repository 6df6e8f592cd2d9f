"""DuckDB-side definitions of the derived fixtures, for the oracle SQL.

These mirror ``fixtures.py`` one for one.  ``with_ctes(body, *names)`` prepends
the named CTEs (and their dependencies) to a query body.
"""

from __future__ import annotations

from textloom.functions import text as T
from textloom.plans import fixtures as FX


def lit(s: str) -> str:
    """SQL string literal (DuckDB keeps backslashes verbatim)."""
    return "'" + s.replace("'", "''") + "'"


SPACE_SQL = " || ".join(f"chr({ord(c)})" for c in T.SPACE_CHARS)


def trim(x: str) -> str:
    return f"trim({x}, {SPACE_SQL})"


def toks(x: str, kind: str) -> str:
    return f"regexp_extract_all({x}, {lit(T.TOKEN_PATTERNS[kind])})"


def pieces(x: str) -> str:
    return f"list_transform(string_split(replace({x}, chr(10), ' '), '. '), lambda s: {trim('s')})"


def hexd(x: str, pos: int, n: int = 1) -> str:
    return f"('0x' || substr({x}, {pos}, {n}))::INTEGER"


TAGS_SQL = "[" + ",".join(lit(t) for t in FX.HASH_TAGS) + "]"

_ACC = (f"replace(replace(translate(text, {lit(FX.ACCENT_FROM)}, {lit(FX.ACCENT_TO)}), "
        f"' l', ' {T.OKINA}'), ' a ', ' {T.LEFT_QUOTE}a ')")

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_lines": ((), """
        SELECT doc_id, generate_subscripts(l, 1)::BIGINT AS line_no, unnest(l) AS raw
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)"""),
    "clean_lines": (("raw_lines",), f"""
        SELECT doc_id, line_no, text FROM (
          SELECT doc_id, line_no, {trim('raw')} AS text FROM raw_lines) WHERE text <> ''"""),
    "acc_text": ((), f"SELECT doc_id, {_ACC} AS text FROM documents"),
    "acc_lines": (("acc_text",), """
        SELECT doc_id, line_no,
               CASE WHEN (doc_id + line_no) % 10 = 0 THEN line_no::VARCHAR || ' ' || raw ELSE raw END AS raw
        FROM (SELECT doc_id, generate_subscripts(l, 1)::BIGINT AS line_no, unnest(l) AS raw
              FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM acc_text))"""),
    "acc_docs": (("acc_text",), """
        SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
               lambda x, i: CASE WHEN (doc_id + i) % 10 = 0 THEN i::VARCHAR || ' ' || x ELSE x END),
               chr(10)) AS text
        FROM acc_text"""),
    "doc_sents": ((), f"""
        SELECT doc_id, sent_no, text FROM (
          SELECT doc_id, generate_subscripts(p, 1)::BIGINT AS sent_no, unnest(p) AS text
          FROM (SELECT doc_id, {pieces('text')} AS p FROM documents)) WHERE text <> ''"""),
    "line_sents": (("clean_lines",), f"""
        SELECT doc_id, line_no, sent_no, text FROM (
          SELECT doc_id, line_no, generate_subscripts(p, 1)::BIGINT AS sent_no, unnest(p) AS text
          FROM (SELECT doc_id, line_no, {pieces('text')} AS p FROM clean_lines)) WHERE text <> ''"""),
    "tagged": (("line_sents",), f"""
        SELECT doc_id, line_no, sent_no, text, tok_idx, form,
          CASE WHEN regexp_matches(form, {lit(T.PUNCT_RE)}) THEN 'PUNCT'
               WHEN regexp_matches(form, '^\\p{{Nd}}+$') THEN 'NUM'
               WHEN regexp_matches(substr(form, 1, 1), '^\\p{{Lu}}$') AND tok_idx > 1 THEN 'PROPN'
               ELSE {TAGS_SQL}[{hexd('md5(lower(form))', 1)} % 8 + 1] END AS upos
        FROM (SELECT doc_id, line_no, sent_no, text, generate_subscripts(t, 1)::INTEGER AS tok_idx,
                     unnest(t) AS form
              FROM (SELECT doc_id, line_no, sent_no, text, {toks('text', 'word_or_symbol')} AS t
                    FROM line_sents))"""),
    "preds": (("tagged",), f"""
        SELECT doc_id, line_no, sent_no, tok_idx, form, upos AS gold,
               CASE WHEN {hexd('h', 1)} < 3 THEN 'NOUN' ELSE upos END AS pred,
               {hexd('h', 2, 2)} / 255.0 AS score
        FROM (SELECT *, md5('p:' || doc_id || ':' || line_no || ':' || sent_no || ':' || tok_idx) AS h
              FROM tagged)"""),
}


def register_cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + head[5:] + ",\n" + stripped[15:]
    if stripped[:5].upper() == "WITH ":
        return head + ",\n" + stripped[5:]
    return head + "\n" + body


register_cte("catalogue", (), """
    SELECT doc_id AS id, lang AS language, source AS author, ceil(n_chars / 1500)::BIGINT AS pages,
           '/cover_img/' || doc_id || '.jpg' AS img FROM documents""")
register_cte("doc_split", (), """
    SELECT doc_id, CASE WHEN r <= greatest(1, floor(n * 0.8::DOUBLE)) THEN 'train'
                        WHEN r <= greatest(1, floor(n * 0.8::DOUBLE)) + greatest(1, floor(n * 0.1::DOUBLE))
                             THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r,
                 count(*) OVER () AS n FROM documents)""")
register_cte("lex_entries", ("acc_lines",), f"""
    SELECT doc_id, line_no, p[1] AS eng, generate_subscripts(p[2:], 1)::INTEGER AS pos, unnest(p[2:]) AS haw
    FROM (SELECT doc_id, line_no, string_split({trim('tsv')}, chr(9)) AS p FROM (
            SELECT doc_id, line_no, array_to_string({toks(trim('raw'), 'ws')}[1:4], chr(9)) AS tsv
            FROM acc_lines) WHERE tsv <> '')""")
register_cte("lex_inv", ("lex_entries",), f"""
    SELECT haw, string_agg(eng, ', ' ORDER BY n DESC, first) AS eng, count(*)::BIGINT AS n_eng,
           min(first) AS first
    FROM (SELECT haw, eng, count(*) AS n, min(struct_pack(d := doc_id, l := line_no, p := pos)) AS first
          FROM (SELECT doc_id, line_no, pos, eng, translate(haw, '{T.LEFT_QUOTE}', '{T.OKINA}') AS haw
                FROM lex_entries)
          WHERE NOT regexp_matches(haw, '^\\p{{Lu}}*$') GROUP BY haw, eng)
    GROUP BY haw""")


def tag_sql(form: str, idx: str) -> str:
    return (f"CASE WHEN regexp_matches({form}, {lit(T.PUNCT_RE)}) THEN 'PUNCT' "
            f"WHEN regexp_matches({form}, '^\\p{{Nd}}+$') THEN 'NUM' "
            f"WHEN regexp_matches(substr({form}, 1, 1), '^\\p{{Lu}}$') AND {idx} > 1 THEN 'PROPN' "
            f"ELSE {TAGS_SQL}[{hexd(f'md5(lower({form}))', 1)} % 8 + 1] END")


def offsets_sql(src: str, keys: list[str], kind: str) -> str:
    """Token offsets from the separators between matches (running sums)."""
    k = ", ".join(keys)
    pat = lit(T.TOKEN_PATTERNS[kind])
    return f"""
    SELECT {k}, tok_idx, token,
           (sum(length(sep) + length(token)) OVER w - length(token))::INTEGER AS start,
           (sum(length(sep) + length(token)) OVER w)::INTEGER AS "end"
    FROM (SELECT {k}, generate_subscripts(t, 1)::INTEGER AS tok_idx, unnest(t) AS token,
                 unnest(s[1:len(t)]) AS sep
          FROM (SELECT {k}, regexp_extract_all(text, {pat}) AS t, regexp_split_to_array(text, {pat}) AS s
                FROM {src}))
    WINDOW w AS (PARTITION BY {k} ORDER BY tok_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


_SK = ["doc_id", "line_no", "sent_no"]
register_cte("offs_wos", ("line_sents",), offsets_sql("line_sents", _SK, "word_or_symbol"))
register_cte("offs_annot", ("line_sents",), offsets_sql("line_sents", _SK, "annot"))
register_cte("spans", ("offs_wos",), f"""
    SELECT doc_id, line_no, sent_no, tok_idx * 2 AS span_ord, start,
           CASE WHEN tok_idx % 7 = 0 THEN "end" + 1 ELSE "end" END AS "end", {tag_sql('token', 'tok_idx')} AS label
    FROM offs_wos WHERE tok_idx % 11 <> 0
    UNION ALL
    SELECT doc_id, line_no, sent_no, tok_idx * 2 + 1, start,
           CASE WHEN tok_idx % 7 = 0 THEN "end" + 1 ELSE "end" END, 'SYM'
    FROM offs_wos WHERE tok_idx % 11 <> 0 AND tok_idx % 13 = 0""")
register_cte("span_keyed", ("spans",), """
    SELECT doc_id, line_no, sent_no, start, "end", arg_max(label, span_ord) AS label, min(span_ord) AS key_ord
    FROM spans GROUP BY doc_id, line_no, sent_no, start, "end"
""")
