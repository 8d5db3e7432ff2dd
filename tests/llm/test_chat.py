import hashlib
import random

from pyspark.sql import functions as F

from berthline.llm import chat


def esc(text):
    text = text.replace("\\", "\\\\")
    for c in chat.CONTROL:
        text = text.replace(c, "\x00" + c[1:] if c[0] == "<" else "\x01" + c[1:])
    return text.replace("\x00", "\\<").replace("\x01", "\\[")


def brute(turns):
    out, mask, before = chat.BEGIN, [], None
    for i, (role, text) in enumerate(turns):
        out += chat.NEXT if before == role else chat.OPEN + esc(role) + chat.TEXT
        start = len(out)
        out += esc(text)
        if role == "assistant":
            mask.append((start, len(out)))
        if i + 1 == len(turns) or turns[i + 1][0] != role:
            out += chat.CLOSE
        before = role
    return out + chat.FINISH, mask


PARTS = ["a", "é", "😀", "\\", "\\\\", " ", "\n", "[", "]", "<", *chat.CONTROL, *[f" {c} " for c in chat.CONTROL], "$1"]


def test_round_trip_and_mask(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for conv in range(60):
        turns = [(rng.choice(["user", "assistant", "system", "a[TEXT]b", ""]), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(1, 9))]
        want[conv] = turns
        rows += [(conv, t, role or None, text or None, 7) for t, (role, text) in enumerate(turns)]
    long = [("user" if i % 3 else "assistant", f"t{i}") for i in range(700)]
    want[99] = long
    rows += [(99, t, role, text, 7) for t, (role, text) in enumerate(long)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    chats = chat.format_chats(df)
    got = {r.conv_id: r for r in chats.select("*", chat.read_back(F.col("formatted")).alias("read")).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        text, mask = brute(turns)
        assert got[conv].formatted == text
        assert [tuple(m) for m in got[conv].mask] == mask
        assert [tuple(t) for t in got[conv].read] == turns
    figures = {r.conv_id: r for r in chat.digests(chats).collect()}
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert figures[conv].n_turns == len(turns) and figures[conv].loss_chars == len(loss)
        assert figures[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert figures[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_nulls_ties_and_empty(spark):
    rows = [(None, None, None, None), (1, 2, "user", "b"), (1, 2, "user", "b"), (1, None, "user", "first"), (1, 2, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.read] for r in chat.format_chats(df).select("conv_id", chat.read_back(F.col("formatted")).alias("read")).collect()}
    assert got == {None: [("", "")], 1: [("user", "first"), ("assistant", "a"), ("user", "b"), ("user", "b")]}
    assert chat.digests(chat.format_chats(df.limit(0))).collect() == []
