"""Masked-LM data preparation and evaluation on Spark (SUB-05, SUB-07, ML-09, AGG-22/23, AGG-27,
JOIN-03, SET-03, PRJ-16).

The reference scores masked positions with a transformer.  Here the model is
re-aimed as a count-based context model learnt from the corpus with Spark
aggregates: P(w | prev, next) from (prev, w, next) counts, backing off to
(prev, w) and to unigram counts.  A masked copy of a sentence is represented
by its position and context only, so expansion is linear in tokens.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.sampling import global_rank

BOS, EOS = "<s>", "</s>"
# Special tokens of the word vocabulary.
UNK, MASK = "<UNK>", "<MASK>"


def words(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Lower-cased ``\\w+`` words with 1-based positions: keys..., pos, word."""
    return (df.select(*keys, F.posexplode(T.tokens(F.lower(F.col(text_col)), "word")).alias("p", "word"))
            .select(*keys, (F.col("p") + 1).cast("int").alias("pos"), "word"))


def word_frequency(w: DataFrame, min_frequency: int = 2) -> DataFrame:
    """AGG-27: word counts with a ``min_frequency`` floor (partial aggregation per word)."""
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_frequency)


def build_vocab(freq: DataFrame) -> DataFrame:
    """Word ids by frequency (desc), ties by word; id = 0-based global rank (skew-free range sort)."""
    return global_rank(freq, [F.desc("n"), F.asc("word")], "_r").select(
        "word", "n", (F.col("_r") - 1).cast("int").alias("id"))


def lookup_ids(w: DataFrame, vocab: DataFrame) -> DataFrame:
    """JOIN-03 + SET-03: id of each word, ``<UNK>`` (id = vocab size) when absent."""
    size = vocab.select(F.count(F.lit(1))).scalar()
    return (w.join(vocab.select("word", "id"), "word", "left")
            .withColumn("id", F.coalesce(F.col("id"), size.cast("int"))))


def _unit(seed: int, *cols) -> Column:
    """Deterministic uniform [0, 1) from md5 (portable across engines)."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *cols))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mask_tokens(ids: DataFrame, keys: list[str], vocab_size: Column, seed: int = 42,
                mlm_probability: float = 0.15) -> DataFrame:
    """SUB-05: choose ``mlm_probability`` of positions; of those 80 % → MASK id, 10 % → a
    random id, 10 % kept.  label = original id when chosen, else -100.  Row-local."""
    keycols = [F.col(k) for k in keys] + [F.col("pos")]
    chosen = _unit(seed, *keycols) < mlm_probability
    r2 = _unit(seed + 1, *keycols)
    rnd = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed + 2)), *keycols)), 1, 8), 16, 10)
           .cast("long") % vocab_size).cast("int")
    mask_id = (vocab_size + 1).cast("int")
    inp = (F.when(~chosen, F.col("id")).when(r2 < 0.8, mask_id).when(r2 < 0.9, rnd).otherwise(F.col("id")))
    return ids.select(*keys, "pos", inp.alias("input_id"),
                      F.when(chosen, F.col("id")).otherwise(F.lit(-100)).alias("label"))


def contexts_from_arrays(df: DataFrame, keys: list[str], text_col: str, min_len: int = 3) -> DataFrame:
    """SUB-07 + PRJ-16: one row per scorable position of texts with at least ``min_len``
    words, with its neighbours (``<s>``/``</s>`` at the edges).  Row-local."""
    a = df.select(*keys, T.tokens(F.lower(F.col(text_col)), "word").alias("_w"))
    a = a.filter(F.size("_w") >= min_len)
    padded = F.concat(F.array(F.lit(BOS)), F.col("_w"), F.array(F.lit(EOS)))
    a = a.select(*keys, "_w", padded.alias("_p"))
    return a.select(*keys, F.posexplode("_w").alias("p", "word"), "_p").select(
        *keys, (F.col("p") + 1).cast("int").alias("pos"), "word",
        F.element_at("_p", F.col("p") + 1).alias("prev"), F.element_at("_p", F.col("p") + 3).alias("next"))


def context_counts(train: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Training counts c(prev, w, next) over the corpus (map-side combined)."""
    c = contexts_from_arrays(train, keys, text_col, min_len=1)
    return c.groupBy("prev", "next", "word").agg(F.count(F.lit(1)).alias("c"))


def fill_mask(positions: DataFrame, keys: list[str], counts: DataFrame, k: int = 5) -> DataFrame:
    """ML-09 + SRT-02: top-k fillers per masked position with probability.

    Level 1: candidates seen between the same neighbours, P = c / c(prev,*,next);
    level 2 (no such context): candidates after ``prev``; level 3: unigrams.
    Top-k is taken per context before joining positions, so a frequent context never
    multiplies.  The rank stands alone in its window and totals are aggregates, so
    Spark limits each group before it shuffles (window group limit).
    Ties by word.
    """
    need = positions.select("prev", "next").distinct()
    tri = counts.join(need, ["prev", "next"], "left_semi")
    w3 = Window.partitionBy("prev", "next").orderBy(F.desc("c"), F.asc("word"))
    tot3 = tri.groupBy("prev", "next").agg(F.sum("c").alias("total"))
    top3 = (tri.withColumn("rank", F.row_number().over(w3)).filter(F.col("rank") <= k).join(tot3, ["prev", "next"])
            .select("prev", "next", "rank", F.col("word").alias("filler"), (F.col("c") / F.col("total")).alias("score")))
    bi = counts.groupBy("prev", "word").agg(F.sum("c").alias("c"))
    bi = bi.join(positions.select("prev").distinct(), "prev", "left_semi")
    w2 = Window.partitionBy("prev").orderBy(F.desc("c"), F.asc("word"))
    tot2 = bi.groupBy("prev").agg(F.sum("c").alias("total"))
    top2 = (bi.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k).join(tot2, "prev")
            .select("prev", "rank", F.col("word").alias("filler"), (F.col("c") / F.col("total")).alias("score")))
    uni = counts.groupBy("word").agg(F.sum("c").alias("c"))
    utot = uni.select(F.sum("c")).scalar()
    top1 = uni.orderBy(F.desc("c"), F.asc("word")).limit(k)
    top1 = top1.select(F.col("word").alias("filler"), (F.col("c") / utot).alias("score"),
                       F.row_number().over(Window.orderBy(F.desc("c"), F.asc("word"))).alias("rank"))
    has3 = need.join(tri.select("prev", "next").distinct().withColumn("_h3", F.lit(True)), ["prev", "next"], "left")
    has2 = positions.select("prev").distinct().join(
        bi.select("prev").distinct().withColumn("_h2", F.lit(True)), "prev", "left")
    p = positions.join(has3, ["prev", "next"], "left").join(has2, "prev", "left")
    l3 = p.filter(F.col("_h3")).join(top3, ["prev", "next"])
    l2 = p.filter(F.col("_h3").isNull() & F.col("_h2")).join(top2, "prev")
    # k unigram fillers for every position without context: an equi-join on a constant
    # against the k-row table (its size is the parameter k)
    l1 = (p.filter(F.col("_h3").isNull() & F.col("_h2").isNull()).withColumn("_one", F.lit(1))
          .join(F.broadcast(top1.withColumn("_one", F.lit(1))), "_one"))
    cols = [*keys, "pos", F.col("rank").cast("int").alias("rank"), "filler", "score"]
    return l3.select(*cols).unionByName(l2.select(*cols)).unionByName(l1.select(*cols))


def gold_ranks(positions: DataFrame, keys: list[str], counts: DataFrame) -> DataFrame:
    """WIN-04 for the context model: rank of the gold word = 1 + candidates of the same
    context with a strictly higher count (unseen gold: 1 + all candidates).

    Ranks come from a per-context table of distinct count values and their
    cumulative sizes, so no position is joined to all candidates of its context.
    """
    need = positions.select("prev", "next").distinct()
    tri = counts.join(need, ["prev", "next"], "left_semi")
    levels = tri.groupBy("prev", "next", "c").agg(F.count(F.lit(1)).alias("m"))
    wl = Window.partitionBy("prev", "next").orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, -1)
    above = levels.withColumn("above", F.coalesce(F.sum("m").over(wl), F.lit(0)))
    total = levels.groupBy("prev", "next").agg(F.sum("m").alias("n_cand"))
    g = (positions.join(tri.select("prev", "next", "word", "c"), ["prev", "next", "word"], "left")
         .join(above.select("prev", "next", "c", "above"), ["prev", "next", "c"], "left")
         .join(total, ["prev", "next"], "left"))
    rank = F.when(F.col("c").isNotNull(), F.col("above") + 1).otherwise(F.coalesce(F.col("n_cand"), F.lit(0)) + 1)
    return g.select(*keys, "pos", rank.cast("long").alias("rank"))


def gold_logprob(positions: DataFrame, keys: list[str], counts: DataFrame, add_k: float = 0.1) -> DataFrame:
    """log P(gold | prev, next) with add-k smoothing over the training vocabulary."""
    need = positions.select("prev", "next").distinct()
    tri = counts.join(need, ["prev", "next"], "left_semi")
    tot = tri.groupBy("prev", "next").agg(F.sum("c").alias("n_ctx"))
    v = counts.select("word").distinct().select(F.count(F.lit(1))).scalar()
    g = (positions.join(tri.select("prev", "next", "word", "c"), ["prev", "next", "word"], "left")
         .join(tot, ["prev", "next"], "left"))
    p = (F.coalesce(F.col("c"), F.lit(0)) + add_k) / (F.coalesce(F.col("n_ctx"), F.lit(0)) + F.lit(add_k) * v)
    return g.select(*keys, "pos", F.log(p).alias("logp"))


MASK = "[MASK]"
NO_MASK = "the text has no [MASK]"


def mask_positions(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """The masks of texts that were written with ``[MASK]``, as fill_mask takes them: keys, pos (word number), prev, next.
    Row-local; a mask beside a mask has it as its neighbour, which no training context has."""
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"(\[MASK\]|[\p{L}\p{N}_]+)"), F.lit(1))
    words = F.transform(words, lambda w: F.when(w == MASK, w).otherwise(F.lower(w)))
    a = texts.select(*keys, words.alias("_w"))
    padded = F.concat(F.array(F.lit(BOS)), F.col("_w"), F.array(F.lit(EOS)))
    a = a.select(*keys, padded.alias("_p"), F.posexplode("_w").alias("_i", "_word")).filter(F.col("_word") == MASK)
    return a.select(*keys, (F.col("_i") + 1).cast("int").alias("pos"), F.element_at("_p", F.col("_i") + 1).alias("prev"),
                    F.element_at("_p", F.col("_i") + 3).alias("next"))


def fill_texts(texts: DataFrame, keys: list[str], text_col: str, counts: DataFrame, k: int = 5) -> DataFrame:
    """ML-09 on written texts: keys, pos, rank, filler, score, hint.  A text without ``[MASK]`` (or a null one) gives one
    row that says so."""
    filled = fill_mask(mask_positions(texts, keys, text_col), keys, counts, k).withColumn("hint", F.lit(None).cast("string"))
    plain = texts.filter(~F.contains(F.coalesce(F.col(text_col), F.lit("")), F.lit(MASK))).select(
        *keys, *[F.lit(None).cast(t).alias(c) for c, t in (("pos", "int"), ("rank", "int"), ("filler", "string"),
                                                           ("score", "double"))], F.lit(NO_MASK).alias("hint"))
    return filled.unionByName(plain)
