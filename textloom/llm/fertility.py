"""Quality rules from tokeniser fertility: how a public vocabulary takes a text apart.

Per document: characters per token, share of byte-fallback tokens, and entropy of the tokens in bits, all over the
tokens of its words by a sentencepiece vocabulary, and characters per token by a byte-level one, too.  Entropy grows with the number of tokens, so what counts is how far it is off the value
expected for that number: a parabola in its logarithm, fitted by least squares for each language (or, without one, each
script).  Each language also has a band per measure: its median and so many robust standard deviations below and above
(``MEASURES``), wider for short documents, whose measures vary more.  A document outside a band is rejected.  Sums,
medians and deviations are over all documents that pass the base rules; medians come from mergeable quantile sketches
of fixed size.

Base rules and counts, over words (runs of other than the six ASCII white-space characters): ``n_words``,
``word_chars`` (code points in words), ``n_symbols`` (of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word, equal to
an earlier line), ``n_repeat_words`` (words covered by a three-word window that occurs twice or more),
``base_failed`` (under 50 words, or over half of the words repeated).

Defined results.  A null text has no words and fails.  A group with under ``LEAST_DOCS`` documents uses the bands of
all documents.  A measure with no spread at all has a band of the least width.  Repeated rows get equal results (and
count as often in the bands), null ids stay, an empty table gives no rows, other columns are ignored.  Texts of any
length are read whole; the memory of words already encoded is bounded.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import MEMORY, ChunkEncoder, KnownIds, in_batches, stored

LEAST_WORDS = 50
LEAST_DOCS = 100
SHORT = 100.0  # words at which the variance of a measure has doubled
OTHERS = ("byte",)  # further vocabularies: a byte-level one
# Least deviation, and the band's width in deviations below and above.
MEASURES = {"chars_per_token": (0.02, 8.0, 8.0), "byte_share": (0.002, 8.0, 8.0), "entropy_off": (0.02, 4.5, 9.0),
            **{f"chars_per_token_{k}": (0.02, 8.0, 8.0) for k in OTHERS}}
_SYMBOLS = bytes(ord("#") if c in b"#*$%&|<>" else ord(" ") for c in range(256))
# Scripts by ranges of code points, tried in this order; fixed values of the public standard.
SCRIPTS = {"latin": r"[A-Za-zÀ-ɏ]", "greek": r"[Ͱ-Ͽ]", "cyrillic": r"[Ѐ-ԯ]",
           "hebrew": r"[֐-׿]", "arabic": r"[؀-ۿ]", "devanagari": r"[ऀ-ॿ]",
           "thai": r"[฀-๿]", "kana": r"[぀-ヿ]", "han": r"[一-鿿]",
           "hangul": r"[가-힯]"}
_SCRIPTS = {k: re.compile(v) for k, v in SCRIPTS.items()}


class WordPieces:
    """Pieces of words by a sentencepiece model, and their number by further vocabularies; a bounded memory of words
    already encoded."""

    def __init__(self, path: str, others: tuple[tuple[str, bool], ...] = (), most: int = MEMORY):
        """``others``: files of the ``tokenizers`` library, and whether they keep white space."""
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.others = [ChunkEncoder(p, keeps) for p, keeps in others]
        self.known = KnownIds(self._learn, most, pa.large_binary())

    def _learn(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each word: how many ids each further vocabulary has for it (after a blank), then its ids."""
        words = [w.decode("utf-8", "replace") for w in new]
        ids = self.model.encode(words, num_threads=1)
        counts = [e.counts([" " + w for w in words] if e.keeps_space else words) for e in self.others]
        rows = [[*c, *i] for *c, i in zip(*counts, ids, strict=True)]
        return np.fromiter(chain.from_iterable(rows), dtype=np.uint32), np.array([len(r) for r in rows], dtype=np.int64)

    def of_texts(self, texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
        """Per text: numbers of its words (equal for equal words), its ids, and its number of ids by each further
        vocabulary."""
        flat = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
        ids, starts, lengths = self.known.look_up(flat.dictionary)
        number, k, end = flat.indices.to_numpy(), len(self.others), 0
        for words in texts:
            at = number[end:end + len(words)]
            end += len(words)
            first, many = starts[at], lengths[at] - k
            place = np.repeat(first + k - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            yield at, ids[place], [int(ids[first + j].sum()) for j in range(k)]


@functools.lru_cache(maxsize=1)
def word_pieces(path: str, others: tuple[tuple[str, bool], ...] = ()) -> WordPieces:
    """The vocabularies that a Python worker used last; tasks of that worker share them."""
    return WordPieces(path, others)


def repeat_words(words: list[bytes] | np.ndarray) -> int:
    """Words (or their numbers) covered by three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    if isinstance(words, np.ndarray):
        at = words.astype(np.uint64)
    else:
        number: dict[bytes, int] = {}
        at = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint64, count=len(words))
    if int(at.max()) < 1 << 21:
        key = at[:-2] << np.uint64(42) | at[1:-1] << np.uint64(21) | at[2:]
    else:  # more words than three of them fit into one integer: number the pairs first
        _, pair = np.unique(at[:-1] << np.uint64(32) | at[1:], return_inverse=True)
        key = pair[:-1].astype(np.uint64) << np.uint64(32) | at[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    often = np.zeros(len(key), dtype=bool)
    often[order[1:]] = same
    often[order[:-1]] |= same
    covered = np.zeros(len(words), dtype=bool)
    covered[:-2] = often
    covered[1:-1] |= often
    covered[2:] |= often
    return int(covered.sum())


def dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    counts = {k: len(p.findall(text)) for k, p in _SCRIPTS.items()}
    best = max(counts, key=counts.__getitem__)
    return f"script:{best if counts[best] else 'none'}"


def measure_all(texts: list[str | None], langs: list[str | None], pieces: WordPieces) -> list[tuple]:
    """Base counts and measures of texts."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    split = [raw.split() for raw in raws]
    out = []
    for text, lang, raw, words, (at, ids, more) in zip(texts, langs, raws, split, pieces.of_texts(split), strict=True):
        counts = (len(words), len(b"".join(words).decode("utf-8", "surrogatepass")) if words else 0,
                  raw.translate(_SYMBOLS).count(b"#"), dup_lines(text or ""), repeat_words(at))
        group = lang if lang is not None else script_of(text or "")
        if not words:
            out.append((*counts, group, 0, 0.0, 0.0, 0.0, *[0.0 for _ in more]))
            continue
        _, times = np.unique(ids, return_counts=True)
        share = times / len(ids)
        out.append((*counts, group, len(ids), counts[1] / len(ids), float(pieces.is_byte[ids].mean()),
                    float(-(share * np.log2(share)).sum()), *[counts[1] / max(1, n) for n in more]))
    return out


def measure(text: str | None, lang: str | None, pieces: WordPieces) -> tuple:
    return measure_all([text], [lang], pieces)[0]


_SCHEMA = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
           "n_repeat_words": pa.int64(), "band_group": pa.string(), "n_tokens": pa.int64(),
           "chars_per_token": pa.float64(), "byte_share": pa.float64(), "token_entropy": pa.float64(),
           **{f"chars_per_token_{k}": pa.float64() for k in OTHERS}}


def _measure_task(path: str, others: tuple[tuple[str, bool], ...], id_col: str, text_col: str, lang_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = word_pieces(path, others)
        for batch in in_batches(batches, 512, text_col, 1 << 21):
            texts, langs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text_col, lang_col))
            found = list(zip(*measure_all(texts, langs, pieces), strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)),
                 *[pa.array(c, t) for c, t in zip(found, _SCHEMA.values(), strict=True)]], ["id", *_SCHEMA])
    return run


def measures(docs: DataFrame, tokenizer_path: str, others: tuple[tuple[str, bool], ...], id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, base counts, group and measures."""
    types = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").cast("string").alias("lang"))
    return rows.mapInArrow(_measure_task(tokenizer_path, others, "id", "text", "lang"),
                           "id long, " + ", ".join(f"{k} {types[t]}" for k, t in _SCHEMA.items())) \
        .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                    | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _fit(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parabolas from the sums of each group (one row per group)."""
    for g in groups:
        found = []
        for r in g.itertuples():
            x = np.array([[r.x0, r.x1, r.x2], [r.x1, r.x2, r.x3], [r.x2, r.x3, r.x4]])
            found.append(np.linalg.lstsq(x, np.array([r.y0, r.y1, r.y2]), rcond=None)[0])
        yield g[["g", "n_docs"]].assign(**{f"c{k}": [float(c[k]) for c in found] for k in range(3)})


def _entropy_off(prefix: str = "") -> Column:
    x = F.log2(F.greatest(F.col("n_tokens"), F.lit(1)).cast("double")) - 8
    c = [F.col(f"{prefix}c{k}") for k in range(3)]
    return F.col("token_entropy") - (c[0] + c[1] * x + c[2] * x * x)


def bands(rows: DataFrame) -> DataFrame:
    """Per group ``g``: the parabola, and the median and robust deviation of each measure; g null is for all rows.

    Deviations are taken at the length of the document: they are divided by ``sqrt(1 + SHORT / n_words)``.
    """
    good = rows.filter("NOT base_failed").select(
        F.explode(F.array(F.col("band_group"), F.lit(None))).alias("g"), "n_words", "n_tokens", "chars_per_token",
        "byte_share", "token_entropy", *[f"chars_per_token_{k}" for k in OTHERS])
    x = F.log2(F.col("n_tokens").cast("double")) - 8
    sums = good.groupBy("g").agg(F.count("*").alias("n_docs"), *[F.sum(F.pow(x, F.lit(k))).alias(f"x{k}")
                                                                 for k in range(5)],
                                 *[F.sum(F.pow(x, F.lit(k)) * F.col("token_entropy")).alias(f"y{k}") for k in range(3)])
    curves = stored(sums.mapInPandas(_fit, "g string, n_docs long, c0 double, c1 double, c2 double"))
    off = good.alias("r").join(curves.alias("m"), F.col("r.g").eqNullSafe(F.col("m.g"))) \
        .withColumn("entropy_off", _entropy_off("m.")).select("r.g", "n_words", *MEASURES)
    accuracy = F.lit(1000)
    middle = stored(off.groupBy("g").agg(*[F.percentile_approx(m, 0.5, accuracy).alias(f"{m}_mid")
                                           for m in MEASURES]))
    apart = off.alias("r").join(middle.alias("m"), F.col("r.g").eqNullSafe(F.col("m.g"))).select("r.g", *[
        (F.abs(F.col(m) - F.col(f"{m}_mid")) / F.sqrt(1 + SHORT / F.col("n_words"))).alias(m) for m in MEASURES])
    spread = apart.groupBy("g").agg(*[
        F.greatest(1.4826 * F.percentile_approx(m, 0.5, accuracy), F.lit(least)).alias(f"{m}_dev")
        for m, (least, _, _) in MEASURES.items()])
    same = lambda k: F.col("c.g").eqNullSafe(F.col(f"{k}.g"))
    return stored(curves.alias("c").join(middle.alias("m"), same("m")).join(spread.alias("s"), same("s"))
                  .select("c.*", *[f"{k}.{m}_{x}" for m in MEASURES for k, x in (("m", "mid"), ("s", "dev"))]))


def judge(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with ``entropy_off``, ``outside`` (the measures that leave their band) and ``kept``."""
    numbers = [c for c in limits.columns if c not in ("g", "n_docs")]
    own = limits.filter((F.col("n_docs") >= LEAST_DOCS) & F.col("g").isNotNull())
    every = limits.filter("g IS NULL").select(*[F.col(c).alias(f"{c}_all") for c in numbers])
    # A row per group and a single row: Spark checks their size before it broadcasts them.
    joined = rows.join(own, F.col("band_group") == F.col("g"), "left").join(every, F.lit(True), "left") \
        .select(*rows.columns, *[F.coalesce(c, f"{c}_all").alias(c) for c in numbers]) \
        .withColumn("entropy_off", _entropy_off())
    at = F.sqrt(1 + SHORT / F.greatest(F.col("n_words"), F.lit(1)))
    off = {m: (F.col(m) - F.col(f"{m}_mid")) / (at * F.col(f"{m}_dev")) for m in MEASURES}
    out = F.filter(F.array(*[F.when((off[m] < -below) | (off[m] > above), F.lit(m))
                             for m, (_, below, above) in MEASURES.items()]), lambda x: x.isNotNull())
    return joined.withColumn("out", out).select(
        *rows.columns, "entropy_off", F.array_join("out", ",").alias("outside"),
        (~F.col("base_failed") & (F.size("out") == 0)).alias("kept"))


def quality(docs: DataFrame, tokenizer_path: str, others: tuple[tuple[str, bool], ...], id_col: str = "doc_id",
            text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` judged by a sentencepiece vocabulary and by the characters per token of the further ones (``OTHERS``,
    files of the ``tokenizers`` library)."""
    rows = stored(measures(docs, tokenizer_path, others, id_col, text_col, lang_col))
    return judge(rows, bands(rows)).withColumnRenamed("id", id_col)
