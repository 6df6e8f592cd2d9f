"""The manifest against a plain recursive tree."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from textloom.llm import langid, merkle


def plain_leaf(row, text):
    told = [row[0], row[3], row[2], row[4], text]
    return sha256("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in told).encode()).hexdigest()


def plain_tree(nodes):
    """All levels, the last one a single node."""
    out = [nodes]
    while len(out[-1]) > 1:
        x = out[-1]
        out.append([sha256("".join(x[k:k + 16]).encode()).hexdigest() for k in range(0, len(x), 16)])
    return out


def climb(levels, place):
    """(left siblings, right siblings) of each level."""
    for level in levels[:-1]:
        start = place // 16 * 16
        yield level[start:place], level[place + 1:start + 16]
        place //= 16


def plain_manifest(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r, r[1])))
        trees.append(plain_tree([plain_leaf(r, r[1]) for r in by_source[s]]))
    top = plain_tree([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, s in enumerate(sources):
        for place, r in enumerate(by_source[s]):
            path = [*climb(trees[k], place), *climb(top, k)]
            value, text = trees[k][0][place], r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
                value = plain_leaf(r, text)
            for left, right in path:
                value = sha256("".join([*left, value, *right]).encode()).hexdigest()
            proof = sha256("".join(x for left, right in path for x in [*left, *right]).encode()).hexdigest()
            out.append((r[0], trees[k][0][place], trees[k][-1][0], root, proof, value, value == root))
    return out


def got_manifest(docs, levels=3):
    leaves = merkle.manifest_leaves(docs, changed={"text": merkle.lower_where(F.col("text"), langid.is_held_out())})
    return [tuple(r) for r in merkle.manifest(leaves, levels).collect()]


def table_of(counts, sources):
    clash = ["x"] * len(odd.CLASHES)
    return [(1000 * k + i, f"Text {i} of {s} ÄÖ", "en", s, i, *clash) for k, (s, n) in enumerate(zip(sources, counts, strict=True))
            for i in range(n)]


# Partitions of one run (one level within a partition), so that small tables need several rounds.
@pytest.mark.parametrize("name, levels", [("odd", 1), ("odd", 3), ("ragged", 1), ("ragged", 2), ("many sources", 1),
                                          ("one leaf", 1)])
def test_manifest(spark, levels, name):
    rows = {"odd": odd.rows(), "ragged": table_of([1, 16, 17, 257, 1100, 273], [None, "", "b", "ä", "a", "B"]),
            "many sources": table_of([1 + k % 3 * 9 for k in range(40)] + [600], [f"s{k}" for k in range(41)]),
            "one leaf": odd.rows()[:1]}[name]
    docs = odd.docs(spark, rows).repartition(3)
    assert sorted(map(repr, got_manifest(docs, levels))) == sorted(map(repr, plain_manifest(rows)))


def test_tampering_is_seen(spark):
    rows = table_of([300], ["s"])
    got = got_manifest(odd.docs(spark, rows))
    assert {r[0]: r[6] for r in got} == {r[0]: zlib.crc32(str(r[0]).encode()) % 5 != 0 for r in rows}


def test_no_leaves(spark):
    assert got_manifest(odd.docs(spark, [])) == []


def test_partitions_hash_their_ancestors_themselves(spark):
    """Every partition ends with the same root and the whole path, also where groups are ragged."""
    sizes = [3, 300, 1]  # partitions of three sources: at 300 the second group of 256 is ragged
    rows, first = [], 0
    for s, n in enumerate(sizes):
        rows += [(first + k, s, first, n, sha256(f"{s}-{k}".encode()).digest()) for k in range(n)]
        first += n
    parts = spark.createDataFrame(rows, "part long, s long, first long, n_parts long, node binary")
    sources = parts.select("s", "first", "n_parts").distinct()
    got = merkle.exchange(parts, sources).collect()
    trees = [plain_tree([r[4].hex() for r in rows if r[1] == s]) for s in range(3)]
    top = plain_tree([t[-1][0] for t in trees])
    assert sorted(r["part"] for r in got) == list(range(sum(sizes)))
    assert {r["root"].hex() for r in got} == {top[-1][0]}
    for r in got:
        s = rows[r["part"]][1]
        path = [*climb(trees[s], r["part"] - rows[r["part"]][2]), *climb(top, s)]
        steps = [(x["at"], [n.hex() for n in x["nodes"]]) for x in r["path"] if x["at"] >= 0]
        assert [(n[:at], n[at + 1:]) for at, n in steps] == path
