"""Secret scans: an Aho-Corasick keyword pass, anchored patterns near its hits, checksums of what they find.

One automaton finds every keyword of every kind in a text; a kind's pattern is only tried at its keyword's
hits.  Runs of hex digits have no keyword; they are found by marking the bytes of the class.  Tokens whose format
carries a checksum (or a header that must decode) count only if it holds.

All patterns are ASCII, so texts are scanned as UTF-8 bytes and only the ends of spans are turned into code points.

Defined results.  A null text is empty and has no spans.  A token header that is no JSON, or nested too deep for the
parser, does not hold.  A text of any length is scanned whole, in time linear in
its length and its hits.  Spans of one kind never overlap; spans of different kinds may.  Repeated rows get equal
results, null ids stay, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import in_batches

KINDS = ("assign", "access", "hex", "github", "npm", "jwt")
BASE = KINDS[:3]

# Keywords, as lower-case text, with the kind they announce.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign",
    "apikey": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm",
    "eyj": "jwt",
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                         re.IGNORECASE),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "jwt": re.compile(rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
}
HEX_LEAST = 24
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_HEX = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))  # h for the class, a blank for the rest


def checksum_holds(token: bytes) -> bool:
    """The last six characters of such tokens are the CRC-32 of the thirty before them, in base 62."""
    body, tail = token[-36:-6], token[-6:]
    value, digits = zlib.crc32(body), b""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = _BASE62[d:d + 1] + digits
    return digits == tail


def header_decodes(token: bytes) -> bool:
    head = token.split(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + b"=" * (-len(head) % 4)))
    except (ValueError, TypeError, RecursionError):  # RecursionError: nested without end
        return False


CHECKS = {
    "assign": lambda m: len(m.group(2)) >= 6,
    "access": lambda m: len(m.group()) >= 20,
    "github": lambda m: checksum_holds(m.group()),
    "npm": lambda m: checksum_holds(m.group()),
    "jwt": lambda m: header_decodes(m.group()),
}


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (len(word), kind))
    found.make_automaton()
    return found


def hex_runs(raw: bytes) -> Iterator[tuple[int, int]]:
    marks, at, least = raw.translate(_HEX), 0, b"h" * HEX_LEAST
    while (start := marks.find(least, at)) >= 0:
        at = marks.find(b" ", start)
        at = len(raw) if at < 0 else at
        yield start, at


def scan(text: str | None, words: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all spans of a text, in order, in code points."""
    if not text:
        return []
    raw = text.encode("utf-8", "surrogatepass")
    found = [(a, KINDS.index("hex"), b) for a, b in hex_runs(raw)]
    hits: dict[str, list[int]] = {}
    for end, (size, kind) in words.iter(raw.lower().decode("latin-1")):
        hits.setdefault(kind, []).append(end - size + 1)
    for kind, starts in hits.items():
        pattern, check, done = PATTERNS[kind], CHECKS[kind], 0
        for start in sorted(starts):
            if start >= done and (m := pattern.match(raw, start)):
                done = m.end()
                if check(m):
                    found.append((start, KINDS.index(kind), done))
    found.sort()
    if len(raw) != len(text):
        place, at, chars = {}, 0, 0
        for x in sorted({p for a, _, b in found for p in (a, b)}):
            chars += len(raw[at:x].decode("utf-8", "surrogatepass"))
            place[x], at = chars, x
        found = [(place[a], k, place[b]) for a, k, b in found]
    return found


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan_task(id_col: str, text_col: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = automaton()
        for batch in in_batches(batches, 1024, text_col, 1 << 22):
            found = [scan(t, words) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            base = [[s for s in f if s[1] < len(BASE)] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)),
                 *[pa.array([sum(s[1] == k for s in f) for f in base], pa.int64()) for k in range(len(BASE))],
                 pa.array([hashlib.sha256(_told(f).encode()).hexdigest() for f in base]),
                 pa.array([_told(f) for f in found])],
                [id_col, *[f"n_{k}" for k in BASE], "base_sha256", "spans"])
    return run


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_assign, n_access, n_hex, base_sha256, spans."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").alias(text_col)) \
        .mapInArrow(_scan_task(id_col, text_col), f"`{id_col}` long, n_assign long, n_access long, n_hex long, "
                                                  "base_sha256 string, spans string")
