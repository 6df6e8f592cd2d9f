"""Derived fixtures (FIXTURES.md §C) built from the driver tables.

Each fixture is a lazy DataFrame derived from a driver table, so its size grows
with the input.  The matching DuckDB definitions live in ``sqlparts.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import annotate

# Accent substitution for fixture C.0.
ACCENT_FROM = "éèêàçáíóúñ"
ACCENT_TO = "āēīōūĀĒĪŌŪ"

# Tag list for fixture C.1.
HASH_TAGS = ["NOUN", "VERB", "ADJ", "ADP", "DET", "PART", "PRON", "ADV"]


def _hexdigit(c: Column, pos: int, n: int = 1) -> Column:
    return F.conv(F.substring(c, pos, n), 16, 10).cast("int")


def raw_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """SRC-01 before trimming: (doc_id, line_no 1-based, raw line)."""
    return (docs.select("doc_id", F.posexplode(F.split(F.col(text), "\n")).alias("pos", "raw"))
            .select("doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "raw"))


def _accent(c: Column) -> Column:
    t = F.translate(c, ACCENT_FROM, ACCENT_TO)
    t = F.replace(t, F.lit(" l"), F.lit(" " + T.OKINA))
    return F.replace(t, F.lit(" a "), F.lit(" " + T.LEFT_QUOTE + "a "))


def accented_docs(docs: DataFrame) -> DataFrame:
    """C.0 at document level: (doc_id, text)."""
    lines = F.split(_accent(F.col("text")), "\n")
    numbered = F.transform(
        lines,
        lambda ln, i: F.when((F.col("doc_id") + i + 1) % 10 == 0,
                             F.concat((i + 1).cast("string"), F.lit(" "), ln)).otherwise(ln))
    return docs.select("doc_id", F.array_join(numbered, "\n").alias("text"))


def accented_lines(docs: DataFrame) -> DataFrame:
    """C.0 at line level: (doc_id, line_no, raw) with the digit prefix applied."""
    lines = raw_lines(docs.select("doc_id", _accent(F.col("text")).alias("text")))
    return lines.select(
        "doc_id", "line_no",
        F.when((F.col("doc_id") + F.col("line_no")) % 10 == 0,
               F.concat(F.col("line_no").cast("string"), F.lit(" "), F.col("raw")))
        .otherwise(F.col("raw")).alias("raw"))


def clean_lines(docs: DataFrame) -> DataFrame:
    """SRC-01: stripped, non-blank lines (doc_id, line_no, text)."""
    return (raw_lines(docs).select("doc_id", "line_no", T.utrim(F.col("raw")).alias("text"))
            .filter(F.col("text") != ""))


def sentences(docs: DataFrame) -> DataFrame:
    """PRJ-04 on documents: (doc_id, sent_no, text)."""
    return annotate.split_sentences(docs, "doc_id", "text")


def tag_rule(form: Column, tok_idx: Column) -> Column:
    """C.1 tag: PUNCT, NUM, PROPN (capitalised, not first), else md5-indexed open-class tag."""
    first = F.substring(form, 1, 1)
    tag_idx = _hexdigit(F.md5(F.lower(form)), 1) % 8
    return (F.when(T.is_punct(form), "PUNCT")
            .when(form.rlike(r"^\p{Nd}+$"), "NUM")
            .when(first.rlike(r"^\p{Lu}$") & (tok_idx > 1), "PROPN")
            .otherwise(F.element_at(F.array(*[F.lit(t) for t in HASH_TAGS]), tag_idx + 1)))


def line_sentences(docs: DataFrame) -> DataFrame:
    """PRJ-04 applied per clean line: (doc_id, line_no, sent_no, text)."""
    return annotate.split_sentences(
        clean_lines(docs).withColumnRenamed("text", "line"), ["doc_id", "line_no"], "line")


def tagged_tokens(docs: DataFrame) -> DataFrame:
    """C.1 synthetic tagged corpus, one row per token.

    Columns: doc_id, line_no, sent_no, text (sentence), tok_idx, form, upos.
    """
    toks = line_sentences(docs).select(
        "doc_id", "line_no", "sent_no", "text",
        F.posexplode(T.tokens(F.col("text"), "word_or_symbol")).alias("p", "form"))
    toks = toks.withColumn("tok_idx", (F.col("p") + 1).cast("int")).drop("p")
    return toks.withColumn("upos", tag_rule(F.col("form"), F.col("tok_idx")))


SENT_KEYS = ["doc_id", "line_no", "sent_no"]


def tagged_sentences(docs: DataFrame) -> DataFrame:
    """C.1 at sentence level: (doc_id, line_no, sent_no, text, tokens, tags) — row-local.

    Tokens get a projection of their own: inside ``transform`` Spark does not share an expression, it would cut them
    again for the tags.
    """
    cut = line_sentences(docs).select(*SENT_KEYS, "text", T.tokens(F.col("text"), "word_or_symbol").alias("tokens"))
    return cut.select("*", F.transform("tokens", lambda t, i: tag_rule(t, i + 1)).alias("tags"))


def span_annotations(docs: DataFrame) -> DataFrame:
    """C.3 spans over C.1 tokens: every 7th widened by one, every 11th removed,
    every 13th duplicated with label SYM.  (doc_id, line_no, sent_no, span_ord, start, end, label)."""
    offs = annotate.token_offsets(line_sentences(docs), SENT_KEYS, "text", "word_or_symbol")
    i = F.col("tok_idx")
    base = offs.filter(i % 11 != 0).select(
        *SENT_KEYS, i, "start", F.when(i % 7 == 0, F.col("end") + 1).otherwise(F.col("end")).alias("end"),
        tag_rule(F.col("token"), i).alias("label"))
    # A token's span and its duplicate come from one row, so texts are cut once.
    span = lambda order, label: F.struct(order.alias("span_ord"), label.alias("label"))
    one, two = span(i * 2, F.col("label")), span(i * 2 + 1, F.lit("SYM"))
    spans = base.select(*SENT_KEYS, "start", "end",
                        F.explode(F.when(i % 13 == 0, F.array(one, two)).otherwise(F.array(one))).alias("s"))
    return spans.select(*SENT_KEYS, "s.span_ord", "start", "end", "s.label")


def annotation_tokens(docs: DataFrame) -> DataFrame:
    """TOK-D tokens of C.1 sentences with offsets: (doc_id, line_no, sent_no, tok_idx, form, start, end)."""
    return (annotate.token_offsets(line_sentences(docs), SENT_KEYS, "text", "annot")
            .withColumnRenamed("token", "form"))


def predictions(docs: DataFrame) -> DataFrame:
    """C.2 synthetic predictions on C.1: gold, pred, score per token."""
    h = F.md5(F.concat_ws(":", F.lit("p"), "doc_id", "line_no", "sent_no", "tok_idx"))
    return tagged_tokens(docs).select(
        "doc_id", "line_no", "sent_no", "tok_idx", "form",
        F.col("upos").alias("gold"),
        F.when(_hexdigit(h, 1) < 3, F.lit("NOUN")).otherwise(F.col("upos")).alias("pred"),
        (_hexdigit(h, 2, 2) / F.lit(255.0)).alias("score"))


def catalogue(docs: DataFrame) -> DataFrame:
    """SRC-06 stand-in: documents as a book catalogue (author = source, language = lang).

    ``pages`` is derived from the length; there is no ``word_count`` column, so
    PRJ-23 falls back to ``pages * 300``.
    """
    return docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("language"), F.col("source").alias("author"),
        F.ceil(F.col("n_chars") / F.lit(1500)).cast("bigint").alias("pages"),
        F.concat(F.lit("/cover_img/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("img"))


def lexicon_tsv(docs: DataFrame) -> DataFrame:
    """C.4 lexicon stand-in as ragged TSV lines: first word, then up to three more."""
    lines = accented_lines(docs)
    words = T.tokens(T.utrim(F.col("raw")), "ws")
    return (lines.select("doc_id", "line_no", F.concat_ws("\t", F.slice(words, 1, 4)).alias("tsv"))
            .filter(F.col("tsv") != ""))


def lexicon_entries(docs: DataFrame) -> DataFrame:
    """SRC-09 over C.4: (doc_id, line_no, pos, eng, haw)."""
    from textloom.sources.formats import parse_ragged_tsv
    return (parse_ragged_tsv(lexicon_tsv(docs), "tsv", ["doc_id", "line_no"])
            .withColumnRenamed("head", "eng").withColumnRenamed("value", "haw"))


def runs(orders: DataFrame) -> DataFrame:
    """C.5 run log: (run_id, experiment, model, start_time, params MAP, metrics MAP).

    experiment 'lm' for open orders, 'pos' otherwise; model = 'm' || custkey;
    metrics derive from the price; every tenth run carries no metrics.
    """
    price = F.col("o_totalprice")
    k = F.col("o_orderkey")
    lm = F.create_map(F.lit("eval_loss"), price / 1e5, F.lit("pseudo_perplexity"), price / 1e3,
                      F.lit("eval_masked_accuracy"), (k % 97) / 97.0, F.lit("eval_masked_top5"), (k % 89) / 89.0,
                      F.lit("eval_masked_mrr"), (k % 83) / 83.0)
    pos = F.create_map(F.lit("eval_accuracy"), price / 6e5, F.lit("eval_f1"), price / 7e5)
    metrics = F.when(k % 10 == 0, F.create_map().cast("map<string,double>")) \
        .when(F.col("o_orderstatus") == "O", lm).otherwise(pos)
    return orders.select(
        k.alias("run_id"),
        F.when(F.col("o_orderstatus") == "O", "lm").otherwise("pos").alias("experiment"),
        F.concat(F.lit("m"), F.col("o_custkey").cast("string")).alias("model"),
        F.col("o_orderdate").alias("start_time"),
        F.create_map(F.lit("name"), F.concat(F.lit("m"), F.col("o_custkey").cast("string")),
                     F.lit("priority"), F.col("o_orderpriority"), F.lit("status"), F.col("o_orderstatus")
                     ).alias("params"),
        metrics.alias("metrics"))


def models(customer: DataFrame) -> DataFrame:
    """Configured model list with its family (PRJ-20 category map)."""
    return customer.select(F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("model"),
                           F.col("c_mktsegment").alias("family"))


def candidates(emb: DataFrame, max_labels: int = 10000) -> DataFrame:
    """C.6: per embedding, logits = dot products with every label centroid; gold = label.

    The centroid matrix (labels × dim) is aggregated into one row, its size
    checked against ``max_labels``, and attached to every row by a broadcast
    equi-join on a constant (one build row), so scoring is row-local.
    """
    from textloom.operators import features as FE
    from textloom.operators import metrics as M
    mean = FE.mean_vector(emb, "embedding", "label")
    cents = mean.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "mean"))).alias("c")) \
        .select("label", F.transform("c", lambda x: x["mean"]).alias("vec"))
    mat = cents.agg(F.collect_list(F.struct("label", "vec")).alias("m"))
    mat = mat.select(F.lit(1).alias("_one"), F.when(F.size("m") > max_labels, F.raise_error(
        F.lit("too many labels for in-row scoring"))).otherwise(F.col("m")).alias("m"))
    j = emb.withColumn("_one", F.lit(1)).join(F.broadcast(mat), "_one")
    logits = F.transform("m", lambda c: F.struct(c["label"].alias("label"),
                                                 M.dot(c["vec"], F.col("embedding").cast("array<double>"))
                                                 .alias("logit")))
    return j.select("vec_id", F.col("label").alias("gold"), logits.alias("logits"))
