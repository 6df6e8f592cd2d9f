"""A small table with every awkward row, and words to write texts with."""

from __future__ import annotations

import random

# Extra columns whose names the operators use inside.
CLASHES = ("id", "rid", "size", "n", "name", "pos", "block", "label", "u", "v", "a", "b", "h", "part", "rank", "rep",
           "print", "g", "target", "taken", "copies", "start", "length", "text_a", "lost_id", "kept", "turns")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string"
                                                                                          for c in CLASHES)
WORDS = {"en": "the of and that with house river stone window garden bright yellow morning people water walking".split(),
         "de": "der und nicht mit haus fluss stein fenster garten hell gelb morgen leute wasser gehen über".split()}


def sentence(lang: str, n: int, seed: int) -> str:
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", "s", "ing", ","]) for _ in range(n)) + "."


def rows() -> list[tuple]:
    out = []
    for k in range(40):
        lang = "de" if k % 3 == 0 else "en"
        out.append((k, sentence(lang, 60 + 7 * k, k), lang, f"s{k % 4}"))
    base = out[5][1]
    out += [
        (100, None, None, None), (101, "", "en", "s0"), (102, " \t\n ", None, ""), (103, "word", "en", None),
        (104, "two words", "de", "s1"), (105, base, "en", "s1"), (106, base.upper(), "en", "s1"),
        (106, base.upper(), "en", "s1"),  # a repeated row
        (107, base + " tail", "en", "s2"), (None, base, "en", "s2"), (None, None, None, None),
        (108, "a b  c\n\n d\te\x0bf g \U0001f600 Été 12.5, x", "de", "s3"),
        (109, " ".join(sentence("en", 900, 1000 + k) for k in range(30)), "en", "s3"),  # a very long one
        (110, "one id, two texts here", "en", "s0"), (110, sentence("de", 80, 7), "de", "s0"),
        (111, "1234 !!! ...", None, "s0"), (112, "İstanbul ſt K", "en", "s0"),
    ]
    return [(i, t, lang, s, len(t) if t is not None else None, *["x"] * len(CLASHES)) for i, t, lang, s in out]


def docs(spark, some: list[tuple] | None = None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)
