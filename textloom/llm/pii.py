"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

Candidates are the spans of the base patterns and of looser ones (local numbers, long numbers with other separators,
spelled-out addresses, colon-separated network addresses).  Each labeler votes yes, no or not at all:

* regex:      the span stands alone (that a base pattern matches is known for certain: base spans always stay)
* validator:  check digit, ranges and lengths
* gazetteer:  known domain endings, calling codes and issuer ranges
* context:    words before the span that announce the kind, or that announce other numbers

Expectation-maximisation estimates how reliable each labeler is, for each kind of its own, from how often votes occur
together (a Dawid-Skene model over counts of vote patterns, grouped by Spark, in which base spans are known to be
personal data; a kind with few candidates leans on the estimate over all kinds).  A logistic
classifier on votes, kind and length is then trained on the estimated probabilities, weighted by the same counts,
and decides which loose candidates count.

Bounds: patterns are (kind, 3 ** labelers votes, 4 lengths), a few thousand rows at most whatever the corpus is; only
their counts reach the driver.

Defined results.  A null text is empty and has no spans.  A text of any length is read whole, in time linear in its
length.  Loose candidates that touch a base span or an earlier loose one of the same kind are dropped.  Repeated
rows get equal results (and count as often in the estimates), null ids stay, an empty table gives no rows, other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import in_batches, stored

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Fixed values of the base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
# Looser patterns, tried only at their anchors.
_LOOSE_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}"
                          r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}){1,4}", re.ASCII | re.IGNORECASE)
_LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])")
_LOOSE_CARD = re.compile(r"[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])")
_LOOSE_PHONE = re.compile(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
# Gazetteers and cue words, as fixed values.  Endings of two letters are country codes, all of them.
ENDINGS = frozenset("""com org net edu gov int mil info biz name pro aero coop museum mobi jobs travel tel cat asia post
    app dev cloud online site store shop blog tech xyz club email agency digital media network solutions systems world
    today life live news group company academy center design studio space website""".split())
# First digits and lengths of card numbers by issuer range (inclusive, both ends of one width).
ISSUERS = (("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)),
           ("37", "37", (15,)), ("6011", "6011", (16, 19)), ("644", "649", (16, 19)), ("65", "65", (16, 19)),
           ("622126", "622925", (16, 19)), ("300", "305", (14, 16, 19)), ("3095", "3095", (14, 16, 19)),
           ("36", "36", (14, 16, 19)), ("38", "39", (14, 16, 19)), ("3528", "3589", (16, 19)), ("62", "62", (16, 19)),
           ("50", "50", (13, 16, 19)), ("56", "58", (13, 16, 19)), ("60", "63", (13, 16, 19)), ("67", "69", (13, 16, 19)))
# Calling codes: those of one and two digits; of the others the first two digits that open codes of three.
SHORT_CODES = frozenset("""1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63
    64 65 66 81 82 84 86 90 91 92 93 94 95 98""".split())
LONG_CODES = frozenset("21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split())
CUES = {
    "email": frozenset("mail email e-mail contact write courriel correo kontakt".split()),
    "ip": frozenset("ip address host server client adresse from dirección".split()),
    "card": frozenset("card visa mastercard amex credit payment carte karte tarjeta".split()),
    "phone": frozenset("call phone tel telephone mobile fax cell téléphone telefon teléfono".split()),
}
OTHER = frozenset("version order isbn invoice serial page section item id no nr part build release".split())
LABELERS = 5


def known_issuer(digits: str) -> bool:
    return any(low <= digits[:len(low)] <= high and len(digits) in lengths for low, high, lengths in ISSUERS)


def known_code(digits: str) -> bool:
    """Whether an international number begins with a calling code."""
    return digits[:1] in SHORT_CODES or digits[:2] in SHORT_CODES or digits[:2] in LONG_CODES


def known_ending(name: str) -> bool:
    end = name.rpartition(".")[2].lower()
    return end in ENDINGS or len(end) == 2 and end.isascii() and end.isalpha()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_emails(text: str) -> list[Span]:
    """Every match ends in the domain after an @; it begins where the run of local characters before that @ does."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    return out


def _from_runs(text: str, runs: list[int], pattern: re.Pattern, fine: Callable[[str], bool]) -> list[Span]:
    out, floor = [], 0
    for start in runs:
        if start >= floor and (m := pattern.match(text, start)):
            floor = m.end()
            if fine(m.group()):
                out.append((start, floor))
    return out


def _ip_parts(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def base_spans(text: str) -> list[list[Span]]:
    """Spans of each kind, leftmost first, without overlaps."""
    runs = [m.start() for m in _DIGITS.finditer(text)]
    phones, floor, at = [], 0, text.find("+")
    while at >= 0:
        if at >= floor and (m := _PHONE.match(text, at)):
            floor = m.end()
            if 9 <= len(_only_digits(m.group())) <= 15:
                phones.append((at, floor))
        at = text.find("+", at + 1)
    return [base_emails(text), _from_runs(text, runs, _IP, _ip_parts),
            _from_runs(text, runs, _CARD, lambda s: 13 <= len(d := _only_digits(s)) <= 19 and luhn(d)), phones]


def loose_spans(text: str, base: list[list[Span]]) -> list[list[Span]]:
    """Looser candidates that do not touch a base span."""
    taken = sorted(s for spans in base for s in spans)
    low = text.lower() if "at]" in text.lower() or "at)" in text.lower() else ""
    found: list[list[Span]] = [[m.span() for m in _LOOSE_EMAIL.finditer(text)] if low else [],
                               [m.span() for m in _LOOSE_IP.finditer(text)] if text.count(":") >= 7 else [], [], []]
    runs = [m.span() for m in _DIGITS.finditer(text)]
    for kind, pattern, widths in ((2, _LOOSE_CARD, (4,)), (3, _LOOSE_PHONE, (3,))):
        floor = 0
        for a, b in runs:
            if b - a in widths and a >= floor and (m := pattern.match(text, a)):
                found[kind].append((a, m.end()))
                floor = m.end()
    out: list[list[Span]] = []
    for spans in found:
        free, i = [], 0
        for a, b in spans:
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if i == len(taken) or taken[i][0] >= b:
                free.append((a, b))
        out.append(free)
    return out


def votes(text: str, kind: int, span: Span) -> list[int]:
    """One vote per labeler (but that of the base patterns): 1 yes, 0 no, 2 none."""
    a, b = span
    found, digits = text[a:b], _only_digits(text[a:b])
    before = [w.strip(".,:;()[]#").lower() for w in text[max(0, a - 40):a].split()[-3:]]
    alone = not (a and (text[a - 1].isalnum() or text[a - 1] in "._-/")) and not (b < len(text) and text[b].isalnum())
    if kind == 0:
        valid, listed = ".." not in found and not found.startswith("."), known_ending(found)
    elif kind == 1:
        head = found.split(".")[0]
        valid = ":" in found or _ip_parts(found)
        listed = 2 if ":" in found else int(head.lstrip("0") or 0) not in (0, 127) and int(head.lstrip("0") or 0) < 224
    elif kind == 2:
        valid = 13 <= len(digits) <= 19 and luhn(digits)
        listed = known_issuer(digits)
    else:
        valid = 9 <= len(digits) <= 15 and not (len(digits) == 10 and digits[0] in "01")
        listed = known_code(digits) if found.startswith("+") else 2
    cue = any(w in CUES[KINDS[kind]] for w in before)
    other = any(w in OTHER for w in before)
    return [int(alone), int(valid), int(listed), 1 if cue else 2, 0 if other else 2]


def pattern_of(text: str, kind: int, span: Span) -> int:
    """Kind, votes and length class of a candidate as one number."""
    number = kind
    for v in votes(text, kind, span):
        number = number * 3 + v
    return number * 4 + min(3, (span[1] - span[0]) // 12)


def unpack(pattern: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes (one row per pattern) and length classes."""
    length, rest, out = pattern % 4, pattern // 4, []
    for _ in range(LABELERS):
        out.append(rest % 3)
        rest = rest // 3
    return rest, np.stack(out[::-1], axis=1), length


def _likelihood(vote: np.ndarray, n: np.ndarray, known: np.ndarray, p: np.ndarray, lean: np.ndarray,
                steps: int) -> tuple[np.ndarray, np.ndarray]:
    """EM over the patterns of one kind (or all): probabilities and reliability[label, labeler, vote].  ``lean`` are
    pseudo-counts of the same shape as the reliabilities."""
    rate = np.zeros((2, LABELERS, 3))
    for _ in range(steps):
        for label, weight in ((0, n * (1 - p)), (1, n * p)):
            for k in range(3):
                rate[label, :, k] = ((vote == k) * weight[:, None]).sum(axis=0) + lean[label, :, k]
            rate[label] /= rate[label].sum(axis=1, keepdims=True)
        prior = ((n * p).sum() + 1) / (n.sum() + 2)
        logs = [np.log(rate[label][np.arange(LABELERS), vote]).sum(axis=1) for label in (0, 1)]
        odds = logs[1] - logs[0] + np.log(prior / (1 - prior))
        new = np.where(known, 1.0, 1 / (1 + np.exp(-np.clip(odds, -500, 500))))
        if np.abs(new - p).max(initial=0) < 1e-9:
            break
        p = new
    return p, rate


LEAN = 10.0  # pseudo-votes per labeler by which a kind leans on the estimate over all kinds


def estimate(pattern: np.ndarray, n: np.ndarray, known: np.ndarray, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """``(probability of each pattern, reliability[kind, label, labeler, vote])`` by expectation-maximisation: first over
    all kinds, then for each kind, starting from there.

    ``known`` patterns are personal data for certain.
    """
    kind, vote, _ = unpack(pattern)
    # The start: the share of yes votes among the votes cast.
    cast = (vote != 2).sum(axis=1)
    start = np.where(known, 1.0, ((vote == 1).sum(axis=1) + 0.5) / (cast + 1))
    p, every = _likelihood(vote, n, known, start, np.ones((2, LABELERS, 3)), steps)
    p, rates = p.copy(), np.repeat(every[None], len(KINDS), axis=0)
    for k in range(len(KINDS)):
        own = kind == k
        if own.any():
            p[own], rates[k] = _likelihood(vote[own], n[own], known[own], p[own], LEAN * every, steps)
    return p, rates


def _features(pattern: np.ndarray) -> np.ndarray:
    kind, vote, length = unpack(pattern)
    return np.concatenate([np.ones((len(pattern), 1)), *[(kind == k)[:, None] for k in range(len(KINDS))],
                           *[vote == k for k in (0, 1)], *[(length == k)[:, None] for k in range(4)]],
                          axis=1).astype(float)


def train(pattern: np.ndarray, n: np.ndarray, p: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic classifier of the probabilities, by Newton steps on the pattern counts."""
    x = _features(pattern)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (n * (p - q)) - ridge * w
        curve = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(pattern: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-_features(pattern) @ weights))


def _find_task(id_col: str, text_col: str) -> Callable:
    span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                      ("pattern", pa.int64())])

    def candidates(text: str | None) -> list[dict]:
        if not text or not ("@" in text or ":" in text or _DIGITS.search(text) or "at]" in (low := text.lower())
                            or "at)" in low):
            return []
        base = base_spans(text)
        out = []
        for strict, spans in ((True, base), (False, loose_spans(text, base))):
            out += [{"kind": k, "start": a, "end": b, "base": strict, "pattern": pattern_of(text, k, (a, b))}
                    for k, found in enumerate(spans) for a, b in found]
        return sorted(out, key=lambda s: (s["kind"], s["start"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 1024, text_col, 1 << 22):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(id_col)),
                 pa.array([candidates(t) for t in texts], pa.list_(span))], ["id", "found"])
    return run


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, found``: all candidates of each row, by kind and start."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias(id_col), F.col(f"`{text_col}`").alias(text_col)) \
        .mapInArrow(_find_task(id_col, text_col),
                    "id long, found array<struct<kind:int,start:long,end:long,base:boolean,pattern:long>>")


def accepted_patterns(candidates: DataFrame, threshold: float = 0.5) -> list[int]:
    """Patterns of loose candidates that the trained classifier accepts."""
    counts = candidates.select(F.explode("found").alias("s")).groupBy("s.pattern", "s.base") \
        .agg(F.count("*").alias("n")).collect()  # bounded: see above
    if not any(not r["base"] for r in counts):
        return []
    pattern, n = (np.array([r[c] for r in counts], dtype=t) for c, t in (("pattern", np.int64), ("n", float)))
    p, _ = estimate(pattern, n, np.array([r["base"] for r in counts]))
    took = score(pattern, train(pattern, n, p)) >= threshold
    return [r["pattern"] for r, t in zip(counts, took, strict=True) if t and not r["base"]]


def _told(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    rows = stored(find_candidates(docs, id_col, text_col))
    took = accepted_patterns(rows)
    base = F.filter("found", lambda s: s["base"])
    chosen = F.filter("found", lambda s: s["base"] | s["pattern"].isin(took)) if took else base
    return rows.withColumn("base", base).withColumn("chosen", chosen).select(
        F.col("id").alias(id_col),
        *[_count(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_told(F.col("base")), 256).alias("base_sha256"), _told(F.col("chosen")).alias("spans"))
