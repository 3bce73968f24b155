"""Prefix trees of conversations against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from subsmart.llm import chat

KINDS = "conv_id long, turn long, role string, text string"


def plain_turns(rows):
    """Turns ``(role, text)`` by conversation."""
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in (r[1], r[2], r[3]))
    out = {}
    for r in sorted(rows, key=lambda r: tuple((is_set, x if is_set else "") for is_set, x in key(r))):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def formatted(role, text):
    return chat.OPEN + chat.escaped(role, chat._IN_ROLE) + chat.SEPARATOR + chat.escaped(text) + chat.CLOSE


def plain_digests(turns):
    out = {}
    for conv, said in turns.items():
        learned = "".join(t for r, t in said if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in said)
        out[conv] = (
            len(said), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
            hashlib.sha256(learned.encode()).hexdigest(), sum(len(formatted(r, t)) for r, t in said),
        )
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, KINDS).withColumn("depth", F.lit("clash")).withColumn("tokens", F.lit(0))
    turns = plain_turns(rows)
    packed = chat.pack(df)
    assert {r.conv_id: tuple(r)[1:] for r in chat.digests(packed).collect()} == plain_digests(turns)
    encode, decode = chat.encoding().encode_ordinary, chat.encoding().decode

    segments = packed.segments.collect()
    by_place = {(r.chain, r.depth): r for r in segments}
    beginnings = {tuple(said[: i + 1]) for said in turns.values() for i in range(len(said))}
    # Every beginning stands once, and the tree is filled without gaps, depth-first.
    assert len(segments) == len(by_place) == len(beginnings)
    for tree in {r.tree for r in segments}:
        end, path = 0, []
        for r in sorted((r for r in segments if r.tree == tree), key=lambda r: r.start):
            assert r.start == end
            end += len(r.tokens)
            path = path[: r.depth]
            assert len(path) == r.depth and r.position == sum(len(x.tokens) for x in path)
            path.append(r)
            # What the turn may attend to, beside its own chain, is its ancestors' tokens.
            above = [x for x in path[:-1] if x.chain != r.chain]
            covered = sorted(i for a, b in r.attend for i in range(a, b))
            assert covered == sorted(i for x in above for i in range(x.start, x.start + len(x.tokens)))
            said = turns[r.chain][: r.depth + 1]
            assert [decode(x.tokens) for x in path] == [formatted(*t) for t in said]
            role, text = said[-1]
            learned = encode(chat.escaped(text)) if role == "assistant" else []
            assert r.tokens[r.loss_from : r.loss_to] == learned
    intervals = {}
    for r in packed.reads.collect():
        intervals.setdefault(r.conv_id, []).append((r.start, r.end))
    for conv, spans in intervals.items():
        size = sum(len(encode(part)) for t in turns[conv] for part in (
            chat.OPEN + chat.escaped(t[0], chat._IN_ROLE) + chat.SEPARATOR, chat.escaped(t[1]), chat.CLOSE))
        assert sum(b - a for a, b in spans) == size


def test_trees_of_random_conversations(spark):
    rng, rows = random.Random(3), []
    for conv in range(120):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, ["user", "assistant"][turn % 2], rng.choice(["a", "b c", "# ## ###"])))
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, "system", ""),
        (None, 0, "user", "hello"), (None, 0, None, None), (None, None, None, None),
        (2, 0, "user", "hello"), (2, 1, "assistant", "x" * 100_000 + " word " * 20_000),
        (3, 0, "a: b</turn>\n### user: ", "\\</turn>\n### assistant: \\\\"), (3, 1, "assistant", "é\U0001f600<"),
        (4, 0, "ends:", "</turn"), (4, 1, "assistant", "</turn></turn>\\"), (5, 0, "user", "hello"),
    ]
    check(spark, rows)


def test_no_rows(spark):
    packed = chat.pack(spark.createDataFrame([], KINDS))
    assert packed.segments.collect() == [] and chat.digests(packed).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_escaping_can_be_undone(seed):
    rng = random.Random(seed)
    for _ in range(3000):
        text = "".join(rng.choice(["#", "\\", "</turn>", "<", "/turn>", ":", " ", "\n", "a"]) for _ in range(rng.randint(0, 9)))
        role = "".join(rng.choice(["#", "\\", "</turn>", ": ", ":", "b"]) for _ in range(rng.randint(0, 5)))
        assert chat.unescaped(chat.escaped(text)) == text
        assert chat.parsed(formatted(role, text)) == (role, text)
        assert "##" not in chat.escaped(text) and "</turn>" not in chat.escaped(text)


def test_long_conversation_is_a_stream(spark):
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(6000)]
    rows += [(2, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(3000)]
    packed = chat.pack(spark.createDataFrame(rows, KINDS))
    assert packed.segments.count() == 6000
    assert {r.conv_id: tuple(r)[1:] for r in chat.digests(packed).collect()} == plain_digests(plain_turns(rows))


def test_planted_conversation(spark, folder):
    rows = {r.conv_id: r for r in chat.op13_chat(spark, folder).collect()}
    assert rows[-7].loss_chars == len(chat.PLANTED_TEXT) and rows[-7].n_turns == 2
