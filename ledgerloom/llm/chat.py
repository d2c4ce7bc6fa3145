"""Chat formatting with Spark expressions: one marked string and one loss mask per conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.native import groups_of, let, running

#: The template. ``<`` starts every control string and never occurs in an escaped text.
OPEN, AFTER_ROLE, NEXT, CLOSE = "<turn:", ">\n", "<next/>", "</turn>\n"


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\b``, ``<`` becomes ``\l`` and ``>`` becomes ``\g``: no control character stays."""
    for plain, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """Undoes ``escape``: every backslash of an escaped text starts one of its three codes."""
    for code, plain in (("\\g", ">"), ("\\l", "<"), ("\\b", "\\")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_chats(turns: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    ``turns`` has conv_id, turn, role, text; other columns are ignored. The turns of a conversation
    are ordered by (turn, role, text), nulls first, so ties and repeated rows have one result. Null
    role and null text count as empty. Null conv_id is a conversation of its own. Neighbours of one
    role share a block, parted by ``<next/>``. ``loss_mask`` lists (start, length) in code points of
    every text written by ``learn_from``, markers left out. No turns, no rows.

    A conversation is one row by nature; all its turns meet in the task that writes it.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")

    # Where a block of equal roles begins, then each block as a slice up to the next beginning.
    starts = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    chats = chats.withColumn("starts", starts)

    def block(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), n)
        own = F.slice("turns", start + 1, end - start)
        role = F.get("turns", start)["role"]
        texts = F.transform(own, lambda t: escape(t["text"]))
        return F.struct(F.concat(F.lit(OPEN), escape(role), F.lit(AFTER_ROLE)).alias("head"), texts.alias("texts"),
                        (role == learn_from).alias("learn"))

    chats = chats.withColumn("blocks", F.transform("starts", block))
    formatted = F.array_join(
        F.transform("blocks", lambda b: F.concat(b["head"], F.array_join(b["texts"], NEXT), F.lit(CLOSE))), ""
    )
    # (characters passed over, characters of the text, whether the text is learnt) for every turn.
    cells = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.transform(
                b["texts"],
                lambda t, i: F.struct(
                    F.when(i == 0, F.length(b["head"])).otherwise(len(NEXT)).alias("before"),
                    F.length(t).alias("own"),
                    F.when(i == F.size(b["texts"]) - 1, len(CLOSE)).otherwise(0).alias("after"),
                    b["learn"].alias("learn"),
                ),
            ),
        )
    )
    def spans(c: Column) -> Column:
        gone = F.transform(c, lambda x: x["before"] + x["own"] + x["after"])
        told = let(running(gone), lambda at: F.transform(c, lambda x, i: F.struct(
            x["learn"].alias("learn"), F.struct((F.get(at, i) + x["before"]).alias("start"), x["own"].alias("length")).alias("span"))))
        return F.transform(F.filter(told, lambda x: x["learn"]), lambda x: x["span"])

    mask = let(cells, spans)
    return chats.select("conv_id", formatted.alias("formatted"), mask.alias("loss_mask"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text), unescaped."""
    blocks = F.filter(F.split(formatted, "</turn>\n", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = F.substring_index(block, AFTER_ROLE, 1)
        body = F.substr(block, F.length(role) + len(AFTER_ROLE) + 1)
        return F.transform(
            F.split(body, NEXT, -1),
            lambda t: F.struct(
                unescape(F.substr(role, F.lit(len(OPEN) + 1))).alias("role"), unescape(t).alias("text")
            ),
        )

    return F.flatten(F.transform(blocks, turns))


def read_learnt(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order.

    Counting code points starts at the front of a string, so the spans are read from pieces that hold
    as many of them as there are pieces.
    """

    def read(own: Column) -> Column:
        first = own[0]["start"]
        last = F.element_at(own, -1)
        piece = F.substr(formatted, first + 1, last["start"] + last["length"] - first)
        return let(piece, lambda text: F.array_join(F.transform(own, lambda s: unescape(F.substr(text, s["start"] - first + 1, s["length"]))), ""))

    def all_of(spans: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(spans))).cast("int"), F.lit(1))
        return let(width, lambda w: F.array_join(F.transform(groups_of(spans, w), lambda k: let(F.slice(spans, k * w + 1, w), read)), ""))

    return let(mask, all_of)


def chat_digest(chats: DataFrame) -> DataFrame:
    """What can be read back from ``format_chats``: one row of counts and hashes per conversation."""
    learnt = read_learnt(F.col("formatted"), F.col("loss_mask"))
    turns = read_turns(F.col("formatted"))
    back = let(turns, lambda t: F.struct(
        F.size(t).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(t, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
    ))
    loss = let(learnt, lambda x: F.struct(F.length(x).cast("long").alias("loss_chars"), F.sha2(x, 256).alias("loss_sha256")))
    return chats.select(
        "conv_id", back.alias("b"), loss.alias("l"), F.length("formatted").cast("long").alias("formatted_chars")
    ).select("conv_id", "b.*", "l.*", "formatted_chars")
