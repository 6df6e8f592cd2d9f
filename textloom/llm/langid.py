"""Language ID by compression: the language whose dictionary makes a text smallest.

Each language has a zstandard raw-content dictionary, filled with excerpts of a bounded sample of labelled texts.
Letters are lower-cased and what lies between them becomes one blank, in dictionaries and texts alike.  A text is cut
into chunks, every chunk is compressed with every dictionary, and the sizes add up over the whole text.  The smallest
sum wins.  Where it wins by a narrow margin the prediction is marked as rejected: by less than ``least_margin`` of
the next size, or, for short texts, by fewer bytes than the learned limit for that length.  Limits come from labelled
texts that are not in the dictionaries, cut to lengths of 8, 16, ... bytes: the least margin at which at most
``WRONG`` of the predictions of that length with such a margin or a larger one are wrong.
Short texts are compressed with a match finder that only takes long matches, since short ones do not pay there.

The fit uses at most ``SAMPLE_DOCS`` texts of each language (the first in the order of a hash of the id) and at most
``EXCERPT`` characters of each (from the middle of its text), so dictionaries stay under 128 kB however large the
corpus is; there are as many as there are labels, ``MOST_LABELS`` at most (more are an error, not cut).  Limits use
``LIMIT_DOCS`` further texts of each language.  Prediction reads every text whole.

Defined results.  A null text, or one without letters, is ``und`` with score 0 and rejected.  Without any labelled
text every prediction is ``und``.  With one language only it wins with score 1.  Ties go to the label that sorts first
and have margin 0, so they are rejected.  Repeated rows get equal results.  An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import in_batches

SAMPLE_DOCS = 128
EXCERPT = 800
CHUNK = 2048
SHORT = 100  # bytes
LEAST_MARGIN = 0.002
MOST_LABELS = 256
LIMIT_DOCS = 64
LIMIT_LENGTHS = (8, 16, 32, 64, 128, 256)  # bytes of letters; each stands for lengths up to its double
WRONG = 0.05
UNKNOWN = "und"
_BETWEEN = re.compile(r"[\W\d_]+")
_SEARCH = {  # match finders: for short texts and for others
    True: dict(strategy=zstandard.STRATEGY_DFAST, min_match=5, window_log=18, hash_log=17, chain_log=17),
    False: dict(strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=5, window_log=18, hash_log=17,
                chain_log=17, target_length=16)}


def letters_only(text: str) -> str:
    return _BETWEEN.sub(" ", text.lower())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS, excerpt: int = EXCERPT) -> dict[str, bytes]:
    """A dictionary per language from rows with a label and a text."""
    sample = _sample(rows, id_col, text_col, lang_col, 0, sample_docs, excerpt).groupBy("lang").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "part"))), lambda x: x["part"]), "\n")
        .alias("content"))
    found = sample.limit(MOST_LABELS + 1).collect()
    if len(found) > MOST_LABELS:
        raise ValueError(f"over {MOST_LABELS} labels in {lang_col}: a dictionary for each would not fit")
    return {r["lang"]: letters_only(r["content"]).encode("utf-8", "surrogatepass") for r in found}


def _sample(rows: DataFrame, id_col: str, text_col: str, lang_col: str, after: int, upto: int,
            excerpt: int) -> DataFrame:
    """``lang, rank, part``: excerpts of the texts of each language from rank ``after`` + 1 to ``upto`` by a hash."""
    known = rows.filter(F.col(f"`{lang_col}`").isNotNull() & (F.char_length(f"`{text_col}`") > 0)) \
        .select(F.col(f"`{lang_col}`").alias("lang"), F.xxhash64(F.col(f"`{id_col}`")).alias("h"),
                F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    begin = F.greatest(F.lit(1), ((F.char_length("text") - excerpt) / 2).cast("int") + 1)
    first = Window.partitionBy("lang").orderBy("h", "id", "part")
    return known.select("lang", "h", "id", F.substring("text", begin, F.lit(excerpt)).alias("part")) \
        .withColumn("rank", F.row_number().over(first)).filter((F.col("rank") > after) & (F.col("rank") <= upto)) \
        .select("lang", "rank", "part")


def fit_limits(rows: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, limit_docs: int = LIMIT_DOCS,
               excerpt: int = EXCERPT) -> dict[int, int]:
    """Per length of ``LIMIT_LENGTHS`` the least margin in bytes that counts, from labelled rows that ``fit`` left."""
    found = _sample(rows, id_col, text_col, lang_col, sample_docs, sample_docs + limit_docs, excerpt).collect()
    model = Classifier(dictionaries)
    return limits_of([(r["lang"], letters_only(r["part"])) for r in found], model)


def limits_of(labelled: list[tuple[str, str]], model: Classifier) -> dict[int, int]:
    out = {}
    for length in LIMIT_LENGTHS:
        won = []
        for lang, text in labelled:
            raw = text.encode("utf-8", "surrogatepass")
            for at in range(0, min(len(raw), 8 * length) - length + 1, length):
                sizes = model.sizes(raw[at:at + length].decode("utf-8", "ignore"))
                if len(sizes) > 1:
                    best, second = sorted(sizes)[:2]
                    won.append((second - best, model.langs[sizes.index(best)] == lang))
        won.sort(reverse=True)
        limit, wrong = (won[0][0] + 1 if won else 1), 0
        for k, (margin, right) in enumerate(won):
            wrong += not right
            below = won[k + 1][0] if k + 1 < len(won) else 0
            if below < margin and wrong <= WRONG * (k + 1):
                limit = below + 1
        out[length] = max(1, limit)
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], chunk: int = CHUNK, limits: dict[int, int] | None = None,
                 least_margin: float = LEAST_MARGIN):
        self.chunk, self.limits, self.least_margin = chunk, limits or {}, least_margin
        self.langs = sorted(dictionaries)
        self.pressers = {short: [self._presser(dictionaries[lang], search) for lang in self.langs]
                         for short, search in _SEARCH.items()}

    @staticmethod
    def _presser(content: bytes, search: dict) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False,
                                                  **search)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(compression_params=how, dict_data=words)

    def sizes(self, text: str) -> list[int]:
        """Compressed size of a whole text with each language's dictionary."""
        return self._sizes(letters_only(text).encode("utf-8", "surrogatepass"))

    def _sizes(self, raw: bytes) -> list[int]:
        chunks = [raw[i:i + self.chunk] for i in range(0, len(raw), self.chunk)]
        return [sum(len(p.compress(c)) for c in chunks) for p in self.pressers[len(raw) < SHORT]]

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """``(language, score, margin, rejected)``: the score weighs the languages by 2 to the power of minus their size."""
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0, 0.0, True
        raw = letters_only(text).encode("utf-8", "surrogatepass")
        sizes = self._sizes(raw)
        best = min(range(len(sizes)), key=sizes.__getitem__)
        score = 1 / sum(2.0 ** -min(s - sizes[best], 1000) for s in sizes)
        others = [s for i, s in enumerate(sizes) if i != best]
        if not others:
            return self.langs[best], score, 1.0, False
        won = min(others) - sizes[best]
        margin = won / min(others)
        return self.langs[best], score, margin, margin < self.least_margin or won < self._limit(len(raw))

    def _limit(self, length: int) -> int:
        """The limit for a length; shorter texts than all take the one of the shortest, texts over twice the longest none."""
        if not self.limits or length >= 2 * max(self.limits):
            return 0
        return self.limits[max((n for n in self.limits if n <= length), default=min(self.limits))]


def _predict_task(dictionaries: dict[str, bytes], limits: dict[int, int] | None, id_col: str, text_col: str,
                  least_margin: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries, limits=limits, least_margin=least_margin)
        for batch in in_batches(batches, 512, text_col, 1 << 21):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            found = [model.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)), *[
                    pa.array([f[k] for f in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]],
                [id_col, "lang_pred", "score", "margin", "rejected"])
    return run


def classify(docs: DataFrame, dictionaries: dict[str, bytes], limits: dict[int, int] | None = None,
             id_col: str = "doc_id", text_col: str = "text", least_margin: float = LEAST_MARGIN) -> DataFrame:
    """One row per row of ``docs``: id_col, lang_pred, score, margin, rejected."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").alias(text_col)) \
        .mapInArrow(_predict_task(dictionaries, limits, id_col, text_col, least_margin),
                    f"`{id_col}` long, lang_pred string, score double, margin double, rejected boolean")


def is_held_out(id_col: str = "doc_id") -> Column:
    """A fifth of the ids, by their crc32; null ids are neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_known(docs: DataFrame, dictionaries: dict[str, bytes], limits: dict[int, int] | None = None,
               text_col: str = "text", least_margin: float = LEAST_MARGIN) -> DataFrame:
    """``docs`` without the rows whose language is rejected."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(dictionaries, limits=limits, least_margin=least_margin)
        for batch in in_batches(batches, 512, text_col, 1 << 21):
            found = [model.predict(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield batch.filter(pa.array([not f[3] for f in found], pa.bool_()))

    return docs.mapInArrow(run, schema)
