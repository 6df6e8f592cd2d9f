"""Text cleaning, HTML, sentence and tokeniser queries (STR-*, TOK-*, PRJ-01..05, WIN-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import annotate, profile
from textloom.plans import fixtures as FX
from textloom.plans.registry import query
from textloom.plans.sqlparts import lit, toks, trim, with_ctes
from textloom.session import Tables, small_batches, spread

DIGIT_LINE_SPARK = r"(?md)^\p{Nd}[^\n]*\n?"
DIGIT_LINE_RE2 = r"(?m)^\p{Nd}[^\n]*\n?"


# For the oracle, the references that occur in the tables ('&amp;' last) and tags without RE2's missing
# possessive forms.  The library itself decodes every HTML5 reference (see the unit tests).
SQL_TAG_RE = r"""</?[A-Za-z!?](?:[^'">]|"[^"]*"|'[^']*')*>|</?[A-Za-z!?][^>]*>"""
SQL_ENTITIES = [(r"&lt;?", "<"), (r"&gt;?", ">"), (r"&quot;?", '"'), (r"&copy;?", "©"), (r"&reg;?", "®"),
                (r"&nbsp;?", "\u00a0"), (r"&middot;", "·"), (r"&apos;", "'"), (r"&#39;", "'"), (r"&#x27;", "'"),
                (r"&amp;?", "&")]


def _html_sql(col: str, joined: bool, strip: bool = True) -> str:
    """STR-03 / STR-04 in DuckDB."""
    sep = "chr(1)" if joined else "''"
    x = f"regexp_replace({col}, {lit(T.HTML_HIDDEN_RE)}, {sep}, 'g')"
    x = f"regexp_replace({x}, {lit(SQL_TAG_RE)}, {sep}, 'g')"
    for pat, rep in SQL_ENTITIES:
        x = f"regexp_replace({x}, {lit(pat)}, {lit(rep)}, 'g')"
    if joined:
        return (f"array_to_string(list_filter(list_transform(string_split({x}, chr(1)), "
                f"lambda s: {trim('s')}), lambda s: s <> ''), ' ')")
    return trim(x) if strip else x


HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)"


@query("clean_drop_digit_lines", with_ctes(f"""
SELECT doc_id, regexp_replace(text, {lit(DIGIT_LINE_RE2)}, '', 'g') AS text FROM acc_docs""",
                                           "acc_docs"))
def clean_drop_digit_lines(spark, sf_dir):
    """PRJ-01 on fixture C.0: delete whole lines that start with a digit."""
    docs = FX.accented_docs(Tables(spark, sf_dir).documents)
    return docs.select("doc_id", F.regexp_replace("text", DIGIT_LINE_SPARK, "").alias("text"))


@query("keep_digit_sentences", with_ctes(f"""
SELECT doc_id, line_no, text FROM (SELECT doc_id, line_no, {trim('raw')} AS text FROM acc_lines)
WHERE regexp_matches(text, {lit(T.DIGIT_START_RE)})""", "acc_lines"))
def keep_digit_sentences(spark, sf_dir):
    """PRJ-03: stripped lines whose first character is a decimal digit."""
    lines = FX.accented_lines(Tables(spark, sf_dir).documents)
    return (lines.select("doc_id", "line_no", T.utrim(F.col("raw")).alias("text"))
            .filter(T.starts_with_digit(F.col("text"))))


@query("html_to_text", f"SELECT page_id, {_html_sql('html', False)} AS text FROM pages")
def html_to_text(spark, sf_dir):
    """STR-03: page HTML → concatenated visible text."""
    small_batches(spark)
    return Tables(spark, sf_dir).pages.select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query("html_text_joined", f"SELECT page_id, {_html_sql('html', True)} AS text FROM pages")
def html_text_joined(spark, sf_dir):
    """STR-04: page HTML → stripped text nodes joined by a space."""
    small_batches(spark)
    return Tables(spark, sf_dir).pages.select("page_id", T.html_text_joined(F.col("html")).alias("text"))


@query("paragraph_rewrite", f"""
SELECT page_id, sent_no, text FROM (
  SELECT page_id, generate_subscripts(p, 1)::BIGINT AS sent_no, unnest(p) AS text FROM (
    SELECT page_id, list_transform(string_split(replace(replace(replace(html, '<p>', ''), '</p>', '. '),
           chr(10), ' '), '. '), lambda s: {trim('s')}) AS p FROM pages)) WHERE text <> ''""")
def paragraph_rewrite(spark, sf_dir):
    """PRJ-05 then PRJ-04: raw page markup split into sentences at paragraph ends."""
    pages = Tables(spark, sf_dir).pages
    return annotate.split_sentences(
        pages.select("page_id", T.paragraph_rewrite(F.col("html")).alias("t")), "page_id", "t")


@query("sentence_split", with_ctes("SELECT doc_id, sent_no, text FROM doc_sents", "doc_sents"))
def sentence_split(spark, sf_dir):
    """PRJ-04 on documents."""
    return FX.sentences(Tables(spark, sf_dir).documents)


@query("fold_diacritics", with_ctes(f"""
SELECT doc_id, line_no, okina, translate(okina, '{T.FOLD_FROM}', '{T.FOLD_TO}') AS folded
FROM (SELECT doc_id, line_no, translate(raw, '{T.LEFT_QUOTE}', '{T.OKINA}') AS okina FROM acc_lines)""",
                                    "acc_lines"))
def fold_diacritics(spark, sf_dir):
    """STR-01 + STR-02 on fixture C.0 lines."""
    lines = FX.accented_lines(Tables(spark, sf_dir).documents)
    ok = T.normalize_okina(F.col("raw"))
    return lines.select("doc_id", "line_no", ok.alias("okina"), T.fold_diacritics(ok).alias("folded"))


def _tok_query(name: str, kind: str, accented: bool):
    src = "acc_docs" if accented else "documents"
    sql = with_ctes(f"""
SELECT doc_id, generate_subscripts(t, 1)::INTEGER AS tok_idx, unnest(t) AS token
FROM (SELECT doc_id, {toks('text', kind)} AS t FROM {src})""", *([src] if accented else []))

    @query(name, sql)
    def run(spark, sf_dir):
        docs = Tables(spark, sf_dir).documents
        if accented:
            docs = FX.accented_docs(docs)
        return (docs.select("doc_id", F.posexplode(T.tokens(F.col("text"), kind)).alias("p", "token"))
                .select("doc_id", (F.col("p") + 1).cast("int").alias("tok_idx"), "token"))

    run.__doc__ = f"Tokeniser '{kind}' over whole documents: (doc_id, tok_idx, token)."
    return run


tokenize_ws = _tok_query("tokenize_ws", "ws", False)                      # TOK-A / TOK-G
tokenize_word = _tok_query("tokenize_word", "word", False)                # TOK-B
tokenize_word_or_symbol = _tok_query("tokenize_word_or_symbol", "word_or_symbol", True)  # TOK-C
tokenize_annot = _tok_query("tokenize_annot", "annot", True)              # TOK-D
tokenize_serving = _tok_query("tokenize_serving", "serving", True)        # TOK-E
tokenize_pretok = _tok_query("tokenize_pretok", "pretok", True)           # TOK-F


@query("tokenize_sklearn", f"""
SELECT doc_id, generate_subscripts(t, 1)::INTEGER AS tok_idx, unnest(t) AS token
FROM (SELECT doc_id, {toks('lower(text)', 'sklearn')} AS t FROM documents)""")
def tokenize_sklearn(spark, sf_dir):
    """TOK-H: lower-cased runs of two or more word characters."""
    docs = Tables(spark, sf_dir).documents
    return (docs.select("doc_id", F.posexplode(T.tokens(F.lower("text"), "sklearn")).alias("p", "token"))
            .select("doc_id", (F.col("p") + 1).cast("int").alias("tok_idx"), "token"))


@query("token_offsets", with_ctes(f"""
SELECT doc_id, line_no, tok_idx, token,
       (sum(length(sep) + length(token)) OVER w - length(token))::INTEGER AS start,
       (sum(length(sep) + length(token)) OVER w)::INTEGER AS "end"
FROM (SELECT doc_id, line_no, generate_subscripts(t, 1)::INTEGER AS tok_idx, unnest(t) AS token,
             unnest(s[1:len(t)]) AS sep
      FROM (SELECT doc_id, line_no, {toks('text', 'annot')} AS t,
                   regexp_split_to_array(text, {lit(T.TOKEN_PATTERNS['annot'])}) AS s
            FROM (SELECT doc_id, line_no, {trim('raw')} AS text FROM acc_lines)))
WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY tok_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
                                  "acc_lines"))
def token_offsets(spark, sf_dir):
    """WIN-06 + TOK-D: annotation tokens of each line with character offsets."""
    lines = FX.accented_lines(spread(Tables(spark, sf_dir).documents.select("doc_id", "text"), "doc_id"))
    lines = lines.select("doc_id", "line_no", T.utrim(F.col("raw")).alias("text"))
    return annotate.token_offsets(lines, ["doc_id", "line_no"], "text", "annot")


# ------------------------------------------------------------ flagship --

@query("host_corpus_stats", f"""
WITH pg AS (SELECT page_id, regexp_extract(url, {lit(HOST_RE)}, 1) AS host,
                   {_html_sql('html', True)} AS text FROM pages),
sent AS (SELECT host, page_id, s FROM (
           SELECT host, page_id, unnest(list_transform(string_split(replace(text, chr(10), ' '), '. '),
                  lambda s: {trim('s')})) AS s FROM pg) WHERE s <> ''),
words AS (SELECT host, unnest({toks('s', 'word')}) AS w FROM sent),
pstat AS (SELECT host, count(*)::BIGINT AS n_pages FROM pg GROUP BY host),
sstat AS (SELECT host, count(*)::BIGINT AS n_sentences FROM sent GROUP BY host),
wstat AS (SELECT host, count(*)::BIGINT AS n_tokens, count(DISTINCT lower(w))::BIGINT AS vocab_size
          FROM words GROUP BY host)
SELECT p.host, p.n_pages, coalesce(s.n_sentences, 0)::BIGINT AS n_sentences,
       coalesce(w.n_tokens, 0)::BIGINT AS n_tokens, coalesce(w.vocab_size, 0)::BIGINT AS vocab_size
FROM pstat p LEFT JOIN sstat s USING (host) LEFT JOIN wstat w USING (host)""")
def host_corpus_stats(spark, sf_dir):
    """Flagship: pages → STR-04 → PRJ-04 → TOK-B → AGG-08/09/10 per host."""
    small_batches(spark)
    pages = Tables(spark, sf_dir).pages.select(
        "page_id", F.regexp_extract("url", HOST_RE, 1).alias("host"),
        T.html_text_joined(F.col("html")).alias("text"))
    return profile.corpus_stats_by(pages, "host", "page_id", "text", "n_pages")
