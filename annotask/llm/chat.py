"""Chat formatting in budgeted windows.

Each turn costs its tokens, and a turn's place in its conversation is the
prefix sum of the costs before it. The conversation's token axis is cut into
cells of half of what the budget leaves beside the system turn; the turns that
end in a cell are one window's new turns, except that a turn longer than a
cell takes a window alone. So windows consist of whole turns, and each of
several new turns is within the budget. A window begins with the system turn
again (once it has been new) and with as many of the turns right before its own
as fit into the history limit and the budget. Only new assistant turns are
under the loss mask: a target that is repeated as history is masked out.

The prefix sums go by blocks of turns and the blocks' sums, history is found
by an equi-join on cells of the token axis: no task holds a whole conversation.

The template is ``<|role|>`` + newline + text + ``<|end|>`` + newline for each turn. In
roles and texts, a backslash is doubled and each control string gets a backslash
after its first character, which breaks it; ``unescaped`` undoes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Control strings of this and of other common chat templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
END = "<|end|>\n"

BUDGET = 2048
HISTORY = 512
# Tokens of a turn's marks.
OVERHEAD = 4
# Turns whose prefix sums one task forms at a time.
BLOCK = 1024
SYSTEM, ASSISTANT = "system", "assistant"


def escaped(column: Column) -> Column:
    out = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(column: Column) -> Column:
    """Each backslash is dropped, and the character after it kept as it is."""
    return F.regexp_replace(column, r"\\(\\?)", "$1")


def turn_tokens(text: Column) -> Column:
    """A turn's cost: a token for every four bytes begun, and its marks."""
    return F.ceil(F.octet_length(text) / F.lit(4)).cast("long") + F.lit(OVERHEAD)


def _key(column: Column) -> Column:
    """A key for any id, null included, so that joins keep the rows where they are."""
    return F.when(column.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), column.cast("string")))


def placed_turns(turns: DataFrame, tokens=turn_tokens, block: int = BLOCK) -> DataFrame:
    """``turns`` (key, conv, turn, role, text) with ``start`` and ``end`` on the
    conversation's token axis and ``first_system``, where its system turn ends."""
    rows = turns.withColumn("cost", tokens(F.col("text"))).withColumn("block", F.floor(F.coalesce("turn", F.lit(0)) / F.lit(block)))
    # Null turns come last, in a block of their own.
    rows = rows.withColumn("block", F.when(F.col("turn").isNull(), F.lit((1 << 62))).otherwise(F.col("block")))
    in_order = W.partitionBy("key", "block").orderBy("turn", "role", "text").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("so_far", F.sum("cost").over(in_order))
    system = F.min(F.when(F.col("role") == SYSTEM, F.struct("so_far", "cost", "role", "text")))
    blocks = rows.groupBy("key", "block").agg(F.sum("cost").alias("cost"), system.alias("system"))
    by_block = W.partitionBy("key").orderBy("block")
    blocks = blocks.withColumn("before", F.coalesce(F.sum("cost").over(by_block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    at = F.when(
        F.col("system").isNotNull(),
        F.struct(
            (F.col("before") + F.col("system.so_far")).alias("end"),
            F.col("system.cost").alias("cost"),
            F.col("system.role").alias("role"),
            F.col("system.text").alias("text"),
        ),
    )
    whole = W.partitionBy("key").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    blocks = blocks.withColumn("first_system", F.first(at, ignorenulls=True).over(whole))
    met = rows.join(blocks.select("key", "block", "before", "first_system"), ["key", "block"])
    end = F.col("before") + F.col("so_far")
    return met.select("key", "conv", "role", "text", "cost", (end - F.col("cost")).alias("start"), end.alias("end"), "first_system")


def chat_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens=turn_tokens,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per window: conv_id, ``window`` (its first new token's place),
    ``text``, ``n_tokens``, ``n_new``, ``new_from`` and ``loss`` spans.

    ``new_from`` is the code point at which the new turns begin; ``loss`` is an
    array of (begin, end) code points, end exclusive, of the new assistant
    texts. Null texts and roles count as empty. Turns are ordered by turn
    (null last), ties by role and text; rows that repeat are turns of their
    own. A turn that alone exceeds the budget is still one window. Null is a
    conversation of its own. An empty table gives an empty table; other
    columns are not read.
    """
    turns = conversations.select(
        _key(F.col(conv_col)).alias("key"),
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    placed = placed_turns(turns, tokens, block)
    beside = F.coalesce(F.col("first_system.cost"), F.lit(0))
    room = F.greatest(F.lit(budget) - beside, F.lit(2))
    cell = F.floor(room / F.lit(2))
    alone = F.col("cost") > cell
    opened = F.concat(F.lit("<|"), escaped(F.col("role")), F.lit("|>\n"))
    body = escaped(F.col("text"))
    made = placed.select(
        "key", "conv", "role", "start", "end", "cost", "first_system",
        room.alias("room"),
        # Of a cell, the turns up to a long one and those after it are apart, as
        # a long turn that ends in a cell is the first to end there.
        F.struct(F.floor((F.col("end") - 1) / cell).alias("cell"), (~alone).alias("rest")).alias("part"),
        F.concat(opened, body, F.lit(END)).alias("form"),
        F.char_length(opened).cast("long").alias("skip"),
        F.char_length(body).cast("long").alias("chars"),
    )
    new = made.groupBy("key", "part").agg(
        F.first("conv").alias("conv"),
        F.sort_array(F.collect_list(F.struct("start", "end", "role", "form", "skip", "chars"))).alias("new"),
        F.min("start").alias("window"),
        F.max("end").alias("until"),
        F.first("room").alias("room"),
        F.first("first_system").alias("system"),
    )
    fresh = F.col("until") - F.col("window")
    new = new.withColumn("allowed", F.greatest(F.least(F.lit(history), F.col("room") - fresh), F.lit(0)))

    # History: turns wholly within the allowed tokens before the window, met by cell.
    wide = F.lit(max(history, 1))
    cells = F.sequence(F.floor((F.col("window") - F.col("allowed")) / wide), F.floor((F.col("window") - 1) / wide))
    asks = new.where("allowed > 0 and window > 0").select(
        "key", "window", "allowed", F.col("system.end").alias("system_end"), F.explode(cells).alias("cell")
    )
    gives = made.where(F.col("cost") <= history).select(
        "key", F.floor(F.col("start") / wide).alias("cell"), "start", "end", "form"
    )
    within = (F.col("start") >= F.col("window") - F.col("allowed")) & (F.col("end") <= F.col("window"))
    # The system turn is repeated as itself.
    other = F.col("system_end").isNull() | (F.col("end") != F.col("system_end"))
    old = (
        asks.join(gives, ["key", "cell"])
        .where(within & other)
        .groupBy("key", "window")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end", "form"))).alias("old"))
    )
    met = new.join(old, ["key", "window"], "left")
    no_turns = F.expr("cast(array() as array<struct<start:bigint,end:bigint,form:string>>)")
    system = F.when(
        F.col("system.end") <= F.col("window"),
        F.concat(F.lit("<|"), escaped(F.col("system.role")), F.lit("|>\n"), escaped(F.col("system.text")), F.lit(END)),
    )
    met = met.withColumn("old", F.coalesce("old", no_turns)).withColumn("retained", F.coalesce(system, F.lit("")))
    lead = F.concat("retained", F.array_join(F.transform("old", lambda t: t["form"]), ""))
    met = met.withColumn("lead", lead).withColumn("new_from", F.char_length("lead").cast("long"))
    # Where each new turn's text begins: the lengths of the forms before it.
    nothing = F.expr("cast(array() as array<struct<role:string,begin:bigint,end:bigint>>)")
    walked = F.aggregate(
        "new",
        F.struct(F.col("new_from").alias("at"), nothing.alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + t["skip"] + t["chars"] + F.lit(len(END))).alias("at"),
            F.concat(
                acc["spans"],
                F.array(F.struct(
                    t["role"].alias("role"),
                    (acc["at"] + t["skip"]).alias("begin"),
                    (acc["at"] + t["skip"] + t["chars"]).alias("end"),
                )),
            ).alias("spans"),
        ),
    )
    targets = F.filter(walked["spans"], lambda s: s["role"] == ASSISTANT)
    system_cost = F.when(F.col("retained") != "", F.col("system.cost")).otherwise(F.lit(0))
    old_cost = F.aggregate("old", F.lit(0).cast("long"), lambda acc, t: acc + t["end"] - t["start"])
    return met.select(
        F.col("conv").alias(conv_col),
        "window",
        F.concat("lead", F.array_join(F.transform("new", lambda t: t["form"]), "")).alias("text"),
        (F.col("until") - F.col("window") + system_cost + old_cost).alias("n_tokens"),
        F.size("new").alias("n_new"),
        "new_from",
        F.transform(targets, lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"))).alias("loss"),
    )


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv, window, turns, targets) parsed from the windows' text alone:
    ``turns`` are the new turns' (role, text), ``targets`` the texts under the loss mask."""
    new = F.substring(F.col("text"), F.col("new_from").cast("int") + 1, F.char_length("text"))
    # Escaping leaves no mark within a turn, so the marks cut the text.
    forms = F.filter(F.split(new, r"<\|end\|>\n"), lambda t: t != "")
    turns = F.transform(
        forms,
        lambda t: F.struct(
            unescaped(F.regexp_extract(t, r"(?s)\A<\|(.*?)\|>\n", 1)).alias("role"),
            unescaped(F.regexp_replace(t, r"(?s)\A<\|.*?\|>\n", "")).alias("text"),
        ),
    )
    targets = F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
    return windows.select(F.col(conv_col).alias("conv"), "window", "text", turns.alias("turns"), targets.alias("targets"))
