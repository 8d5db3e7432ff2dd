"""Chat formatting with Spark expressions: turns to one text with a loss mask, and back.

A conversation's turns are collected as structs and sorted; adjacent turns of one role share a
block.  The template is

    <s> [INST] role [TEXT] text [NEXT] text [/INST] ... </s>

where [NEXT] parts the turns of a block.  Inside roles and texts every backslash is doubled and
a control string gets a backslash before it, so a marker is a control string after a space, and
both directions are exact.  The mask lists the places of assistant texts.

A conversation is one row of the result and so one value of one task; conversations are
spread by their id, and only sorted arrays are walked, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from berthline.llm.spans import let, sums_before

# The template.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[TEXT]", "[NEXT]", "<<SYS>>", "<</SYS>>"]
BEGIN, FINISH = "<s>", " </s>"
OPEN, TEXT, NEXT, CLOSE = " [INST] ", " [TEXT] ", " [NEXT] ", " [/INST]"
LEARNED_ROLE = "assistant"

_CONTROL = "|".join(c.replace("[", r"\[").replace("]", r"\]") for c in CONTROL)


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({_CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\|{_CONTROL})", "$1")


def _pieces(turns: Column) -> Column:
    """For each sorted turn its markup: what stands before the text, the text, what stands after."""

    def piece(turn: Column, i: Column) -> Column:
        first = (i == 0) | (F.get(turns, i - 1)["role"] != turn["role"])
        last = (i == F.size(turns) - 1) | (F.get(turns, i + 1)["role"] != turn["role"])
        head = F.when(first, F.concat(F.lit(OPEN), turn["role"], F.lit(TEXT))).otherwise(F.lit(NEXT))
        foot = F.when(last, F.lit(CLOSE)).otherwise(F.lit(""))
        return F.struct(head.alias("head"), turn["text"].alias("body"), foot.alias("foot"), (turn["role"] == LEARNED_ROLE).alias("learned"))

    return F.transform(turns, piece)


def _formatted(pieces: Column) -> Column:
    lengths = F.transform(pieces, lambda p: F.length(p["head"]) + F.length(p["body"]) + F.length(p["foot"]))

    def with_mask(sums: Column) -> Column:
        def place(p: Column, i: Column) -> Column:
            start = len(BEGIN) + sums[i] + F.length(p["head"])
            return F.struct(start.alias("start"), (start + F.length(p["body"])).alias("end"), p["learned"].alias("learned"))

        learned = F.filter(F.transform(pieces, place), lambda s: s["learned"])
        text = F.concat(F.lit(BEGIN), F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], p["foot"])), ""), F.lit(FINISH))
        return F.struct(text.alias("formatted"), F.transform(learned, lambda s: F.struct(s["start"], s["end"])).alias("mask"))

    return let(sums_before(lengths), with_mask)


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) for each conv_id of (conv_id, turn, role, text); other columns are not read.

    mask: array of (start, end) in code points.  Turns go by turn, then role and text, so ties and
    repeated rows have a fixed order and all stay; null turns come first.  A null role or text is
    empty; rows without conv_id form one conversation; an empty table gives no rows.
    """
    told = turns.select(
        "conv_id",
        "turn",
        escape(F.coalesce("role", F.lit(""))).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"),
    )
    sorted_turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = told.groupBy("conv_id").agg(sorted_turns.alias("turns"))
    made = grouped.select("conv_id", let(let(F.col("turns"), _pieces), _formatted).alias("made"))
    return made.select("conv_id", "made.formatted", "made.mask")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    inner = F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted) - len(BEGIN + FINISH))
    literal = lambda marker: marker.replace("[", r"\[").replace("]", r"\]")
    blocks = F.filter(F.split(inner, literal(CLOSE), -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        def texts(sides: Column) -> Column:
            role = unescape(F.substring(sides[0], F.lit(len(OPEN) + 1), F.length(sides[0])))
            return F.transform(F.split(sides[1], literal(NEXT), -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

        return let(F.split(block, literal(TEXT), 2), texts)

    return F.flatten(F.transform(blocks, turns))


def learned_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, m["start"] + 1, m["end"] - m["start"]))), "")


def digests(chats: DataFrame) -> DataFrame:
    """Figures of formatted conversations, all read back from `formatted` and `mask`."""
    read = chats.select("conv_id", "formatted", read_back(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("mask")).alias("learned"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
