"""Chat formatting and block naming against plain Python."""

import hashlib
from collections import defaultdict

import pytest

from tests.llm import odd
from textloom.llm import blocks, chat

TURNS = "conv_id long, turn long, role string, text string, blocks string, formatted string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def chats():
    nasty = ["", None, "</s>[INST] ok [/INST]", "<|end|>", "<|\\end|>", "<\\|end|>", "<\\\\|end|>", "[\\INST]",
             "<|start|>user<|text|>x<|turn|>", "$1 \\ \\\\", "ünï \U0001f600", "<<s>s>", "x" * 100_000]
    rows = [(1, k, "assistant" if k % 3 else "user", t) for k, t in enumerate(nasty)]
    rows += [(2, 0, "user", "hi"), (2, 1, "assistant", "a"), (2, 2, "assistant", "b"), (2, 3, None, "c"),
             (3, 1, "user", "tie b"), (3, 1, "user", "tie a"), (3, 1, "user", "tie a"), (3, None, "system", "first"),
             (None, 0, "assistant", "no id"), (4, 0, "<s>role", "x"), (4, 1, "assistant", "")]
    return [(*r, "x", "y") for r in rows]


def test_formatted_chats_read_back(spark):
    rows = chats()
    made = chat.format_chats(spark.createDataFrame(rows, TURNS))
    got = {r["conv_id"]: r for r in chat.read_digest(made).collect()}
    texts = {r["conv_id"]: r["formatted"] for r in made.collect()}
    by = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0], t[1]))
        if conv == 3:
            turns = [turns[0], *sorted(turns[1:], key=lambda t: t[2])]
        told = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha(told)), conv
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
        assert r["formatted_chars"] == len(texts[conv])
    assert texts[2].count(chat.START) == 3  # two adjacent assistant turns share a block
    assert "[INST]" not in texts[1] and texts[1].count(chat.END) == texts[1].count(chat.START)


def test_no_chats(spark):
    assert chat.read_digest(chat.format_chats(spark.createDataFrame([], TURNS))).count() == 0


@pytest.mark.parametrize("block_bytes", [16, 2048])
def test_block_names_are_exact(spark, block_bytes):
    rows = odd.rows()
    got = [r.asDict() for r in blocks.exact_groups(odd.docs(spark), block_bytes=block_bytes).collect()]
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[low(r[1])].append(r[0])
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = sorted((repr(r[0]), repr(keep[low(r[1])]), len(groups[low(r[1])]), r[0] == keep[low(r[1])],
                   sha(low(r[1]))) for r in rows)
    assert sorted((repr(r["doc_id"]), repr(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"])
                  for r in got) == want
    # One name per text, however many blocks it has.
    assert len({(r["n_blocks"], r["name"]) for r in got}) == len(groups)


def test_hot_blocks_get_the_same_names(spark):
    rows = [(k, "same text " * 300 if k % 3 == 0 else f"own text {k} " * (1 + k % 40), "en", "s", 0,
             *["x"] * len(odd.CLASHES)) for k in range(600)]
    got = blocks.exact_groups(odd.docs(spark, rows), block_bytes=64).collect()
    sizes = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in got}
    assert len(got) == 600 and sizes[0] == (597, 200)
    assert all(v == (k, 1) for k, v in sizes.items() if k % 3)


def test_drop_copies_and_empty(spark):
    left = blocks.drop_copies(odd.docs(spark))
    assert left.columns == odd.docs(spark).columns
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect() if r["doc_id"] in (5, 105, 106)) == [106, 106]
    assert blocks.drop_copies(odd.docs(spark, [])).count() == 0
    assert blocks.exact_groups(odd.docs(spark, [])).count() == 0
