"""Sentence/token tables and annotation alignment (PRJ-04, SRC-03..05, JOIN-01/02/07..09, WIN-02/03/06)."""



import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def split_sentences(df: DataFrame, keys, text_col: str) -> DataFrame:
    """PRJ-04: newline → space, split on '. ', strip, drop blanks.

    ``sent_no`` is the 1-based piece position (stable, computed per row, no
    shuffle).  Output: keys..., sent_no, text.
    """
    k = _keys(keys)
    return (df.select(*k, F.posexplode(T.sentence_pieces(F.col(text_col))).alias("p", "text"))
            .filter(F.col("text") != "")
            .select(*k, (F.col("p") + 1).cast("bigint").alias("sent_no"), "text"))


_OFFSET_SCHEMA = "struct<tokens:array<string>,starts:array<int>,ends:array<int>>"

# The tokenisers in Python ``re`` syntax (Unicode \w and \s).
PY_TOKEN_PATTERNS = {
    "ws": r"\S+",
    "word": r"\w+",
    "word_or_symbol": r"\w+|\S",
    "annot": r"\w+ʻ?\w*|['ʻ\w]+|[^\w\s]",
    "serving": r"\w+ʻ?\w+|['ʻ\w]+|[^\w\s]",
    "pretok": r"\w+|[^\w\s]",
}


def _offsets_udf(kind: str):
    import re
    from itertools import chain

    import pyarrow as pa

    pattern = re.compile(PY_TOKEN_PATTERNS[kind])

    @F.arrow_udf(_OFFSET_SCHEMA)
    def offsets(texts: pa.Array) -> pa.Array:
        # Flat columns of all texts' tokens, and where each text's begin: no list per text.
        tokens, spans, firsts = [], [], [0]
        for t in texts.to_pylist():
            found = () if t is None else list(pattern.finditer(t))
            tokens.extend(map(re.Match.group, found))
            spans.extend(map(re.Match.span, found))
            firsts.append(len(tokens))
        flat = np.fromiter(chain.from_iterable(spans), np.int32, 2 * len(spans)).reshape(-1, 2)
        # A text of null has lists of null.
        none = np.append(texts.is_null().to_numpy(zero_copy_only=False), False)
        at = pa.array(np.array(firsts, np.int32), mask=none) if none.any() else pa.array(firsts, pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(v)) for v in
                 (pa.array(tokens, pa.string()), np.ascontiguousarray(flat[:, 0]), np.ascontiguousarray(flat[:, 1]))]
        return pa.StructArray.from_arrays(lists, ["tokens", "starts", "ends"])

    return offsets


def token_offsets(df: DataFrame, keys, text_col: str, kind: str = "annot") -> DataFrame:
    """WIN-06: tokens with their character offsets.

    Row-local Arrow-batched UDF (linear per text, no shuffle).  Output: keys...,
    tok_idx (1-based), token, start, end.
    """
    k = _keys(keys)
    o = df.select(*k, _offsets_udf(kind)(F.col(text_col)).alias("o"))
    z = F.arrays_zip(F.col("o.tokens").alias("token"), F.col("o.starts").alias("start"),
                     F.col("o.ends").alias("end"))
    return (o.select(*k, F.posexplode(z).alias("p", "t"))
            .select(*k, (F.col("p") + 1).cast("int").alias("tok_idx"),
                    F.col("t.token").alias("token"), F.col("t.start").alias("start"),
                    F.col("t.end").alias("end")))


# ------------------------------------------------------------------ CoNLL-U --

CONLLU_FIELDS = ["id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc"]


def conllu_token_line(idx, form, upos, lemma=None):
    """SNK-02 row: ``idx form lemma upos _ _ 0 dep _ _`` (lemma defaults to lower(form))."""
    lem = F.lower(form) if lemma is None else lemma
    return F.concat_ws("\t", idx.cast("string"), form, lem, upos, F.lit("_"), F.lit("_"),
                       F.lit("0"), F.lit("dep"), F.lit("_"), F.lit("_"))


def to_conllu_blocks(tokens: DataFrame, sent_keys, sent_id: Column, text: Column,
                     idx_col: str = "tok_idx", form_col: str = "form", upos_col: str = "upos") -> DataFrame:
    """SNK-02: one CoNLL-U block per sentence: ``# sent_id``, ``# text``, token rows.

    Groups by sentence (one shuffle; a group is one sentence's tokens) and
    orders rows by token index.  Output: sent_keys..., block.
    """
    k = _keys(sent_keys)
    rows = tokens.select(*k, sent_id.alias("_sid"), text.alias("_text"), F.col(idx_col).alias("_i"),
                         conllu_token_line(F.col(idx_col), F.col(form_col), F.col(upos_col)).alias("_row"))
    grouped = rows.groupBy(*k).agg(
        F.first("_sid").alias("_sid"), F.first("_text").alias("_text"),
        F.array_sort(F.collect_list(F.struct("_i", "_row"))).alias("_rows"))
    header = F.concat(F.lit("# sent_id = "), F.col("_sid"), F.lit("\n# text = "), F.col("_text"), F.lit("\n"))
    body = F.array_join(F.transform("_rows", lambda r: r["_row"]), "\n")
    return grouped.select(*k, F.concat(header, body).alias("block"))


def conllu_block_from_arrays(sent_id: Column, text: Column, tokens: Column, tags: Column) -> Column:
    """SNK-02 for tagged sentences held as arrays: the block is built inside the row (no shuffle)."""
    rows = F.transform(F.arrays_zip(tokens.alias("f"), tags.alias("u")),
                       lambda z, i: conllu_token_line(i + 1, z["f"], z["u"]))
    header = F.concat(F.lit("# sent_id = "), sent_id, F.lit("\n# text = "), text, F.lit("\n"))
    return F.concat(header, F.array_join(rows, "\n"))


def write_conllu(blocks: DataFrame, path: str, block_col: str = "block", compression: str = "none") -> None:
    """SNK-02 sink: every block is followed by one blank line.  The columns repeat themselves, so compressed files are a
    fraction of plain ones, but each is then read by one task."""
    blocks.select(F.concat(F.col(block_col), F.lit("\n")).alias("value")).write.mode("overwrite") \
        .option("lineSep", "\n").text(path, compression=compression)


def _comment(block_col: str, key: str) -> Column:
    return F.regexp_extract(F.col(block_col), rf"(?:^|\n)#[ \t]*{key}[ \t]*=[ \t]*([^\r\n]*)", 1)


def conllu_sentences(df: DataFrame, block_col: str = "block", keys=()) -> DataFrame:
    """SRC-03: one row per sentence block: keys..., sent_id, text (the lifted comments)."""
    return df.select(*list(keys), _comment(block_col, "sent_id").alias("sent_id"),
                     _comment(block_col, "text").alias("text"))


def parse_conllu_blocks(df: DataFrame, block_col: str = "block", keys=(), keep_ghosts: bool = False) -> DataFrame:
    """SRC-03: one record per sentence block → one row per token, row-local.

    Tokens carry ``sent_id`` but not the sentence's text (``conllu_sentences`` has it once), so a block costs
    time and space in proportion to its length.  Rows whose ID is not an integer (ghost rows, multi-word ranges,
    empty nodes) are dropped unless ``keep_ghosts``.
    """
    k = list(keys)
    # Expressions selected next to a generator are evaluated above it, once per output
    # row; computing them in the projection below keeps them once per block.
    staged = df.select(*k, _comment(block_col, "sent_id").alias("sent_id"),
                       F.split(F.col(block_col), "\r?\n").alias("_lines"))
    base = staged.select(*k, "sent_id", F.posexplode("_lines").alias("_line", "_r"))
    base = base.filter(~F.col("_r").startswith("#") & (T.utrim(F.col("_r")) != ""))
    split = base.select(*k, "sent_id", "_line", F.split("_r", "\t").alias("_f"))
    out = split.select(*k, "sent_id", (F.col("_line") + 1).cast("int").alias("line_in_block"),
                       *[F.try_element_at("_f", F.lit(i + 1)).alias(n) for i, n in enumerate(CONLLU_FIELDS)])
    if not keep_ghosts:
        out = out.filter(F.col("id").rlike(r"^[0-9]+$"))
    return out


def read_conllu_blocks(spark, path: str) -> DataFrame:
    """SRC-03 from files: ``src, block``, a row per sentence.

    Records end at blank lines, so files are read in parallel pieces.  In files with other line ends (CRLF) or with
    white space in their blank lines a record holds several sentences; it is cut where it is.
    """
    records = spark.read.option("lineSep", "\n\n").text(path)
    block = F.explode(F.split("value", r"\r?\n(?:[ \t]*\r?\n)+")).alias("block")
    return records.select(F.col("_metadata.file_path").alias("src"), block) \
        .filter(F.regexp_replace("block", r"\s", "") != "")


def read_conllu(spark, path: str, keep_ghosts: bool = False) -> DataFrame:
    """SRC-03 from files: one row per token, with its file."""
    return parse_conllu_blocks(read_conllu_blocks(spark, path), "block", ["src"], keep_ghosts)


# Bilingual numbered comment (``# 7. <text> = <translation>``).
COMMENT_RE = rf"^#[{T.SPACE}]*\p{{Nd}}+\.[{T.SPACE}]*([^\n]+?)[{T.SPACE}]*=[{T.SPACE}]*[^\n]*$"


def comment_sentence(line: Column) -> Column:
    """PRJ-06: the sentence of a ``# N. sentence = translation`` comment, else null."""
    ln = T.utrim(line)
    m = F.regexp_extract(ln, COMMENT_RE, 1)
    return F.when(ln.startswith("#") & ln.contains("=") & ln.rlike(COMMENT_RE), T.utrim(m))


def comment_text(line: Column) -> Column:
    """PRJ-07: strip '#' and spaces from the left, then strip."""
    return T.utrim(F.regexp_replace(line, r"^[# ]+", ""))


# ------------------------------------------------------------ span joins --

SPAN_BUCKET = 64


def span_table(spans: DataFrame, sent_keys) -> DataFrame:
    """SRC-05 semantics: spans keyed by (start, end); the last label written for a
    key wins, the key keeps the position of its first occurrence (dict order)."""
    k = _keys(sent_keys)
    return spans.groupBy(*k, "start", "end").agg(
        F.max_by("label", "span_ord").alias("label"), F.min("span_ord").alias("key_ord"))


def exact_labels(tokens: DataFrame, spans: DataFrame, sent_keys, default: str = "_") -> DataFrame:
    """JOIN-01: label of the span with exactly the token's offsets, else ``default``."""
    k = _keys(sent_keys)
    keyed = span_table(spans, k).select(*k, "start", "end", F.col("label").alias("_lab"))
    return (tokens.join(keyed, k + ["start", "end"], "left")
            .withColumn("label", F.coalesce(F.col("_lab"), F.lit(default))).drop("_lab"))


def _buckets(start: Column, end: Column) -> Column:
    last = F.greatest(start, end - 1)
    return F.sequence(F.floor(start / SPAN_BUCKET), F.floor(last / SPAN_BUCKET))


def best_labels(tokens: DataFrame, spans: DataFrame, sent_keys, tok_keys) -> DataFrame:
    """JOIN-02: exact non-empty label; else the first overlapping span in
    annotation order; else PUNCT for punctuation tokens; else X.

    The overlap search is a bucketed range join: spans and tokens are exploded
    into the fixed-width character buckets they touch and equi-joined on
    (sentence, bucket) with the overlap test as residual, so work is
    proportional to local overlaps, never to all pairs of a sentence.
    """
    k = _keys(sent_keys)
    tk = _keys(tok_keys)
    # Spans end with their sentence's last token at the latest: an end far beyond it would only make buckets.
    last = tokens.groupBy(*k).agg(F.max("end").alias("_last"))
    keyed = span_table(spans, k)
    clipped = keyed.join(last, k).withColumn("end", F.greatest("start", F.least("end", "_last")))
    exact = keyed.select(*k, "start", "end", F.col("label").alias("_exact"))
    sb = clipped.select(*k, F.col("start").alias("_ss"), F.col("end").alias("_se"), "label", "key_ord",
                      F.explode(_buckets(F.col("start"), F.col("end"))).alias("_b"))
    tb = tokens.select(*k, *[c for c in tk if c not in k], "start", "end",
                       F.explode(_buckets(F.col("start"), F.col("end"))).alias("_b"))
    overlap = (tb.join(sb, k + ["_b"])
               .filter(~((F.col("end") <= F.col("_ss")) | (F.col("start") >= F.col("_se"))))
               .groupBy(*dict.fromkeys(k + tk))
               .agg(F.min_by("label", "key_ord").alias("_over")))
    j = (tokens.join(exact, k + ["start", "end"], "left")
         .join(overlap, list(dict.fromkeys(k + tk)), "left"))
    label = (F.when(F.coalesce(F.col("_exact"), F.lit("")) != "", F.col("_exact"))
             .when(F.col("_over").isNotNull(), F.col("_over"))
             .when(T.is_punct(F.col("form")), F.lit("PUNCT"))
             .otherwise(F.lit("X")))
    return j.withColumn("label", label).drop("_exact", "_over")


def sweep_labels(tokens: list[tuple[int, int]], spans: list[tuple[int, int, str | None]]) -> list[str | None]:
    """JOIN-02 within a sentence: per token (start, end), in order, the label of the span with exactly its offsets if
    that is not empty, else of the first span in annotation order that overlaps it, else None.

    Spans are keyed by (start, end) as in ``span_table``.  One pass over both in the order of their starts: a span
    enters a queue by annotation order when a token reaches it, and leaves it when a token begins behind its end.
    """
    keyed: dict[tuple[int, int], list] = {}
    for order, (start, end, label) in enumerate(spans):
        if start is not None and end is not None:
            keyed.setdefault((start, end), [order, None])[1] = label
    waiting = sorted((start, end, order, label) for (start, end), (order, label) in keyed.items())
    queue: list[tuple[int, int, str | None]] = []
    out, at = [], 0
    for start, end in tokens:
        while at < len(waiting) and waiting[at][0] < end:
            heapq.heappush(queue, (waiting[at][2], waiting[at][1], waiting[at][3]))
            at += 1
        while queue and queue[0][1] <= start:
            heapq.heappop(queue)
        exact = keyed.get((start, end), (0, None))[1]
        out.append(exact or (queue[0][2] if queue else None))
    return out


def span_labels(df: DataFrame, keys, text_col: str, json_col: str, kind: str = "annot") -> DataFrame:
    """JOIN-02 (+ JSN-01) where a text and its label JSON are in one row: keys..., tok_idx, form, start, end, label.

    Row-local: the text is cut into tokens and its spans are met in one sweep; a token without a span is PUNCT or X.
    """
    import re

    import pandas as pd

    k = _keys(keys)
    pattern = re.compile(PY_TOKEN_PATTERNS[kind])

    @F.pandas_udf("struct<form:array<string>,start:array<int>,end:array<int>,label:array<string>>")
    def labelled(texts: pd.Series, starts: pd.Series, ends: pd.Series, labels: pd.Series) -> pd.DataFrame:
        forms, firsts, lasts, names = [], [], [], []
        for text, *spans in zip(texts, starts, ends, labels, strict=True):
            found = [] if text is None else list(pattern.finditer(text))
            forms.append([m.group() for m in found])
            firsts.append([m.start() for m in found])
            lasts.append([m.end() for m in found])
            names.append(sweep_labels([m.span() for m in found], list(zip(*spans, strict=True))))
        return pd.DataFrame({"form": forms, "start": firsts, "end": lasts, "label": names})

    # The JSON is parsed in a projection of its own, once for the three arrays that Python gets.
    parsed = df.select(*k, F.col(text_col).alias("_text"), _spans_in(F.col(json_col)).alias("_s"))
    rows = parsed.select(*k, labelled(F.col("_text"), F.col("_s.start").cast("array<double>"),
                                      F.col("_s.end").cast("array<double>"),
                                      F.transform("_s", lambda x: x["labels"][0])).alias("t"))
    z = F.arrays_zip(*[F.col(f"t.{c}").alias(c) for c in ("form", "start", "end", "label")])
    rows = rows.select(*k, F.posexplode(z).alias("p", "t"))
    label = F.coalesce("t.label", F.when(T.is_punct(F.col("t.form")), F.lit("PUNCT")).otherwise(F.lit("X")))
    return rows.select(*k, (F.col("p") + 1).cast("int").alias("tok_idx"), "t.form", "t.start", "t.end",
                       label.alias("label"))


def written_rows(df: DataFrame, order: list[str], text_col: str, json_col: str, variant: str = "labelled") -> DataFrame:
    """PRJ-14 + WIN-02: the annotation rows that become sentences, with ``sent_id`` from 1 in the order of ``order``.

    ``labelled``: rows with spans and a text; only written rows are counted.  ``texts``: rows with a text; all rows are
    counted, so numbers may have gaps.
    """
    from textloom.operators.sampling import global_rank
    has_text = T.utrim(F.coalesce(F.col(text_col), F.lit(""))) != ""
    if variant == "labelled":
        df = df.filter(has_text & (F.size(_spans_in(F.col(json_col))) > 0))
    elif variant != "texts":
        raise ValueError(f"no such variant: {variant}")
    ranked = global_rank(df, [F.col(c) for c in order], "sent_id")
    return ranked if variant == "labelled" else ranked.filter(has_text)


# ------------------------------------------------------------ labels --

def label_ids(tags: DataFrame, tag_col: str = "upos") -> DataFrame:
    """AGG-17: sorted distinct labels, id = 0-based rank (the label set is small)."""
    from pyspark.sql import Window
    d = tags.select(F.col(tag_col).alias("label")).distinct()
    return d.withColumn("id", (F.row_number().over(Window.orderBy("label")) - 1).cast("int"))


def zip_tokens_tags(df: DataFrame, keys, tokens_col: str = "tokens", tags_col: str = "tags") -> DataFrame:
    """PRJ-11 + JOIN-07: drop sentences whose arrays differ in length, flatten the
    pairs, drop blank tokens.  Row-local (no shuffle).

    The lengths are compared where the pairs are made: Spark would push a filter below the projections that make the
    arrays, and make them once more for it."""
    k = _keys(keys)
    pairs = F.arrays_zip(F.col(tokens_col).alias("token"), F.col(tags_col).alias("tag"))
    same = F.size(tokens_col) == F.size(tags_col)
    flat = df.select(*k, F.posexplode(F.when(same, pairs)).alias("p", "z"))
    return (flat.select(*k, (F.col("p") + 1).cast("int").alias("tok_idx"),
                        F.col("z.token").alias("token"), F.col("z.tag").alias("tag"))
            .filter(T.utrim(F.col("token")) != ""))


SPAN_JSON_SCHEMA = "array<struct<start:int,end:int,labels:array<string>>>"


def spans_to_json(spans: DataFrame, sent_keys) -> DataFrame:
    """JSN-01 serialise: one label-JSON string per sentence, spans in annotation order."""
    k = _keys(sent_keys)
    # A label becomes an array after the shuffle; there it would be twice as long.
    g = spans.groupBy(*k).agg(F.array_sort(F.collect_list(F.struct("span_ord", "start", "end", "label"))).alias("_s"))
    return g.select(*k, F.to_json(F.transform("_s", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.array(s["label"]).alias("labels")))).alias("label_json"))


def _spans_in(json: Column) -> Column:
    """The spans of a label JSON that have labels, in order."""
    parsed = F.coalesce(F.from_json(json, SPAN_JSON_SCHEMA), F.array())
    return F.filter(parsed, lambda s: F.coalesce(F.size(s["labels"]), F.lit(0)) > 0)


def spans_from_json(df: DataFrame, sent_keys, json_col: str) -> DataFrame:
    """SRC-05 / JSN-01 parse: label JSON → span rows; spans without labels dropped,
    blank or malformed JSON → no spans.  Label = first of ``labels``."""
    k = _keys(sent_keys)
    return (df.select(*k, F.posexplode(_spans_in(F.col(json_col))).alias("span_ord", "s"))
            .select(*k, "span_ord", F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                    F.col("s.labels")[0].alias("label")))


def map_labels(df: DataFrame, ids: DataFrame, tag_col: str) -> DataFrame:
    """JOIN-04: label → id by a join with the label table (Spark broadcasts it when it is
    small enough); an unseen label fails the job."""
    j = df.join(ids.withColumnRenamed("label", tag_col), tag_col, "left")
    j = j.withColumn("id", F.when(F.col("id").isNull(),
                                  F.raise_error(F.concat(F.lit("unknown label: "), F.col(tag_col))))
                     .otherwise(F.col("id")))
    return j.withColumnRenamed(tag_col, "label")


def tagged_string(tokens: Column, tags: Column) -> Column:
    """STR-09: ``word/TAG word/TAG``."""
    return F.array_join(F.zip_with(tokens, tags, lambda w, t: F.concat_ws("/", w, t)), " ")


def ngrams(words: Column, n: int) -> Column:
    """STR-10: space-joined n-grams of a token array (empty when too short)."""
    idx = F.sequence(F.lit(1), F.size(words) - n + 1)
    grams = F.transform(idx, lambda i: F.concat_ws(" ", *[F.get(words, i + j - 1) for j in range(n)]))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def split_quality(df: DataFrame, split_col: str = "split", tokens: str = "tokens", tags: str = "tags") -> DataFrame:
    """PRJ-13 + PRJ-12: data checks per split in one aggregate (no fail-fast pass per check)."""
    t, g = F.col(tokens), F.col(tags)
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(t.isNull() | (F.size(t) == 0)).alias("n_empty_tokens"),
        F.count_if(F.size(t) != F.size(g)).alias("n_size_mismatch"),
        F.sum(F.size(F.filter(g, lambda x: x == "_"))).cast("bigint").alias("n_placeholder"))


def reject_placeholders(df: DataFrame, tags: str = "tags") -> DataFrame:
    """PRJ-12: fail the job if any tag is the placeholder '_'."""
    bad = F.exists(F.col(tags), lambda x: x == "_")
    return df.filter(F.when(bad, F.raise_error(F.lit("placeholder label '_' in training data")))
                     .otherwise(F.lit(True)))
