"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import Scratch, cut_lineage  # noqa: F401  (Scratch: for the operators)

# A word is a run of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    return cut_lineage(df)


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  A text without other characters takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, ASCII_UPPER, ASCII_LOWER))


def split_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes, A-Z lower-cased (``bytes.split`` knows the same six characters)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def in_batches(batches: Iterator[pa.RecordBatch], rows: int, text: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches to at most ``rows`` rows and about ``size`` bytes of ``text`` (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum([len(x.as_buffer()) if x.is_valid else 0 for x in column.cast(pa.large_binary())]) \
            if batch.num_rows else np.zeros(0, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            end = min(int(np.searchsorted(ends, done + size, side="right")), at + rows)
            end = max(end, at + 1)
            yield batch.slice(at, end - at)
            at = end


def _byte_letters() -> dict[int, str]:
    """The public rule by which byte-level vocabularies spell bytes: printable ones as they are, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(256 + k) for k, b in enumerate(others)}


_SPELLED = _byte_letters()


MEMORY = 32 << 20  # bytes of known chunks and ids that an encoder keeps
LONGEST_KNOWN = 40  # bytes: longer chunks are encoded anew each time


class KnownIds:
    """Ids of chunks already seen, in flat arrays of at most ``most`` bytes (half of them go when it is too many)."""

    def __init__(self, learn: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int = MEMORY,
                 kind: pa.DataType = pa.large_string()):
        """``learn`` gives the ids of chunks, one after the other, and how many each has."""
        self.learn, self.most = learn, most
        self.chunks = pa.array([], kind)
        self.ids, self.lengths = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int32)

    def nbytes(self) -> int:
        return self.chunks.nbytes + self.ids.nbytes + self.lengths.nbytes

    def look_up(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct ``chunks``: a flat array of ids, where in it each chunk's begin, and how many it has."""
        # Known chunks are looked up among the given ones, whose hash table is the smaller one.
        found = pc.index_in(self.chunks, value_set=chunks)
        known = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        at = np.full(len(chunks), -1, dtype=np.int64)
        at[found.drop_null().to_numpy()] = known
        new = np.flatnonzero(at < 0)
        fresh = chunks.take(pa.array(new))
        ids, many = self.learn(fresh.to_pylist())
        flat, lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, many.astype(np.int32)])
        at[new] = np.arange(len(self.lengths), len(lengths))
        starts = (np.cumsum(lengths, dtype=np.int64) - lengths)[at]
        self._remember(fresh, ids, many)
        return flat, starts, lengths[at].astype(np.int64)

    def _remember(self, fresh: pa.Array, ids: np.ndarray, many: np.ndarray) -> None:
        short = pc.binary_length(fresh).to_numpy() <= LONGEST_KNOWN
        self.chunks = pa.concat_arrays([self.chunks, fresh.filter(pa.array(short))])
        self.ids = np.concatenate([self.ids, ids[np.repeat(short, many)]])
        self.lengths = np.concatenate([self.lengths, many[short].astype(np.int32)])
        while self.nbytes() > self.most and len(self.lengths):  # the older half goes
            old = (len(self.lengths) + 1) // 2
            self.ids = self.ids[int(self.lengths[:old].sum()):].copy()
            self.lengths = self.lengths[old:].copy()
            self.chunks = pa.concat_arrays([self.chunks[old:]])


class ChunkEncoder:
    """Exact ids of whole texts from a ``tokenizers`` file, with a bounded memory of chunks already encoded.

    A text is cut only where the file's own pre-tokeniser always cuts (at blanks, line ends, and before a full stop
    or comma that follows a letter or digit), so the ids of the chunks, joined, are the ids of the text.  Where the
    vocabulary keeps white space, a text with other white space than single blanks and line ends between words goes
    to the library whole.  Where it does not, it also lower-cases, which is done first for texts within Latin-1,
    whose characters it maps one to one.
    """

    def __init__(self, path: str, keeps_space: bool, most: int = MEMORY):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.known = KnownIds(self._learn, most)

    def _pack(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of Latin-1 letters are one pre-token each and go straight to the file's model, as it spells bytes."""
        model, lengths, rest, ids = self.tokenizer.model.tokenize, np.zeros(len(new), dtype=np.int64), [], []
        for k, chunk in enumerate(new):
            blank = "\u0120" if self.keeps_space and chunk[:1] == " " else ""
            word = chunk[1:] if blank else chunk
            if not word.isalpha() or not self.keeps_space and word != word.lower():
                rest.append(k)
                continue
            if not word.isascii():
                if max(word) > "\xff":
                    rest.append(k)
                    continue
                word = word.encode().decode("latin-1").translate(_SPELLED)
            found = model(blank + word)
            lengths[k] = len(found)
            ids += [t.id for t in found]
        others = self._pack([new[k] for k in rest])
        lengths[rest] = [len(x) for x in others]
        out = np.empty(int(lengths.sum()), dtype=np.uint32)
        is_rest = np.zeros(len(new), dtype=bool)
        is_rest[rest] = True
        is_rest = np.repeat(is_rest, lengths)
        out[~is_rest] = ids
        out[is_rest] = list(chain.from_iterable(others))
        return out, lengths

    def counts(self, chunks: list[str]) -> list[int]:
        """How many ids each chunk has, without remembering it.  (Lower-casing Latin-1 first changes nothing where the
        file does so.)"""
        if not self.keeps_space:
            chunks = [c.lower() if c.isascii() or max(c) <= "\xff" else c for c in chunks]
        return self._learn(chunks)[1].tolist()

    def _marked(self, text: str) -> str | None:
        """The text with a mark wherever it may be cut; None if it has to stay whole."""
        if self.keeps_space:
            if not text or odd_space(text):
                return None
            mark = "\x00"
            text = text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ")
        else:
            mark = " "
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
            text = text.replace("\n", " ")
        if not odd_stop(text):
            text = text.replace(".", mark + ".").replace(",", mark + ",")
        return text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        marked = [self._marked(t) for t in texts]
        cut = pc.split_pattern(pa.array([m or "" for m in marked], pa.large_string()), "\x00" if self.keeps_space else " ")
        chunks = cut.values.dictionary_encode()
        ids, starts, lengths = self.known.look_up(chunks.dictionary)
        number = chunks.indices.to_numpy()
        each = lengths[number]
        ends = np.concatenate(([0], np.cumsum(each)))
        place = np.int32 if ends[-1] < 2**31 and len(ids) < 2**31 else np.int64
        at = np.repeat((starts[number] - ends[:-1]).astype(place), each)
        at += np.arange(len(at), dtype=place)
        flat = ids[at].tobytes()
        bounds = (4 * ends[cut.offsets.to_numpy()]).tolist()
        return [flat[a:b] if m is not None else np.array(self._pack([t])[0], dtype="<u4").tobytes()
                for t, m, a, b in zip(texts, marked, bounds[:-1], bounds[1:], strict=True)]


# Every white-space character but blank and line end, the separators that some libraries count among them, and \x00.
_ODD = "\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" \
    + "".join(map(chr, range(0x2000, 0x200B)))


def odd_space(text: str) -> bool:
    """White space other than single blanks and line ends between words."""
    return text[0] in " \n" or text[-1] in " \n" or any(x in text for x in ("  ", " \n", "\n ", "\n\n")) \
        or any(x in text for x in _ODD)


# Latin-1 letters and ASCII digits as a, full stops and commas as ., the rest as a blank.
_KINDS = bytes(ord("a") if chr(c).isascii() and chr(c).isalnum() or c >= 0xC0 and c not in (0xD7, 0xF7)
               else ord(".") if chr(c) in ".," else ord(" ") for c in range(256))


def odd_stop(text: str) -> bool:
    """A full stop or comma that does not follow a Latin-1 letter or an ASCII digit (other letters count as odd)."""
    kinds = text.encode("latin-1", "replace").translate(_KINDS)
    return kinds[:1] == b"." or b" ." in kinds or b".." in kinds


@functools.lru_cache(maxsize=1)
def chunk_encoder(path: str, keeps_space: bool, most: int = MEMORY) -> ChunkEncoder:
    """The encoder that a Python worker used last; tasks of that worker share it."""
    return ChunkEncoder(path, keeps_space, most)
