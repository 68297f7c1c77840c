"""Chat formatting in windows of a token budget, by DataFrame functions only.

Every turn belongs to one window as new text. Prefix sums of the turns' tokens (runs of letters, digits or
marks) cut a conversation into stretches of about a budget, and within a stretch turns fill windows one after
the other as far as the budget goes, so no group is larger than a stretch. A window is the opening system
turn, then up to ``history`` last turns before its first new one as far as ``history_tokens`` go, both repeated,
then its new turns. A turn too long for the budget has a window to itself; turns are never cut.

A turn is written ``<|role|>``, a line feed, its text, ``<|end|>``, a line feed. In role and text a backslash
follows each ``<``, ``[``, ``|`` and backslash, so no control string (``</s>``, ``[INST]``, ``<|end|>``, ...) survives inside
them, and taking it away again gives back the text. Loss spans, [start, end) in characters of a window,
cover the texts of new assistant turns; repeated turns are masked.

Cases: a null text or role is empty; a null conv_id is a conversation of its own; rows with equal turn are
ordered by role and text, a null turn comes first; repeated rows are turns of their own; an empty table gives no
windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskloom.functions.spans import let

BUDGET, HISTORY, HISTORY_TOKENS = 1024, 2, 256
END = "<|end|>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[|])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[|])\\", "$1")


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}]+"))


def _written(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), escaped(role), F.lit("|>\n"), escaped(text), F.lit(END))


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_tokens: int = HISTORY_TOKENS
) -> DataFrame:
    """conv_id, stretch, window, n_turns, n_repeated, n_tokens, formatted, loss (spans), in the order of stretch and window."""
    turns = conversations.select(
        "conv_id", F.col("turn").alias("_turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = turns.withColumn("written", _written(F.col("role"), F.col("text"))).withColumn("tokens", tokens(F.col("written")))
    order = Window.partitionBy("conv_id").orderBy("_turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    one = F.struct("written", "tokens")
    opening = F.first(F.when(F.col("role") == "system", one)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    number = F.row_number().over(order)
    # The last turns before this one, the opening system turn left out; nearest first.
    earlier = F.array(*[
        F.when(number - k > F.when(opening.isNull(), 0).otherwise(1), F.lag(one, k).over(order)) for k in range(1, history + 1)
    ])
    turns = turns.select(
        "conv_id", number.alias("number"), "role", "text", "written", "tokens", opening.alias("opening"), earlier.alias("earlier"),
        F.floor(F.coalesce(F.sum("tokens").over(before), F.lit(0)) / budget).alias("stretch"),
    )
    # Within a stretch, at most a budget of tokens and one more turn long.
    # (sorted by number: turns are numbered without gaps)
    stretch = turns.groupBy("conv_id", "stretch").agg(
        F.sort_array(F.collect_list(F.struct("number", "role", "text", "written", "tokens", "opening", "earlier"))).alias("turns")
    )

    def room(turn: Column) -> Column:
        """Tokens of what a window repeats if it starts with this turn."""
        return F.when(turn["number"] > 1, F.coalesce(turn["opening"]["tokens"], F.lit(0))).otherwise(0) + F.aggregate(
            kept(turn), F.lit(0), lambda n, t: n + t["tokens"]
        )

    def kept(turn: Column) -> Column:
        """The earlier turns that fit, nearest first: as many as prefix sums of their tokens allow."""
        def fits(t: Column, i: Column) -> Column:
            upto = F.aggregate(F.slice(turn["earlier"], 1, i + 1), F.lit(0), lambda n, e: n + F.coalesce(e["tokens"], F.lit(history_tokens + 1)))
            return t.isNotNull() & (upto <= history_tokens)

        return F.filter(turn["earlier"], fits)

    start = F.struct(F.lit(0).alias("window"), F.lit(0).alias("used"), F.array().cast("array<int>").alias("windows"))

    def deal(state: Column, turn: Column) -> Column:
        opens = (F.size(state["windows"]) == 0) | (state["used"] + turn["tokens"] > budget)
        window = state["window"] + F.when(opens, 1).otherwise(0)
        return F.struct(
            window.alias("window"), (F.when(opens, room(turn)).otherwise(state["used"]) + turn["tokens"]).alias("used"),
            F.concat(state["windows"], F.array(window)).alias("windows"),
        )

    dealt = stretch.select(
        "conv_id", "stretch", "turns", F.aggregate("turns", start, deal, lambda s: s["windows"]).alias("windows")
    )
    cut = dealt.select("conv_id", "stretch", "turns", "windows", F.explode(F.array_distinct("windows")).alias("window"))
    cut = cut.select(
        "conv_id", "stretch", "window", F.filter("turns", lambda t, i: F.get(F.col("windows"), i) == F.col("window")).alias("new")
    )
    first = F.get("new", 0)
    repeated = F.concat(
        F.when((first["number"] > 1) & first["opening"].isNotNull(), F.array(first["opening"])).otherwise(F.array().cast("array<struct<written:string,tokens:int>>")),
        F.reverse(kept(first)),
    )
    cut = cut.withColumn("repeated", repeated)
    head = F.array_join(F.transform("repeated", lambda t: t["written"]), "")
    lengths = F.transform("new", lambda t: F.char_length(t["written"]))

    def spans(base: Column) -> Column:
        def span(t: Column, i: Column) -> Column:
            end = base + F.aggregate(F.slice(lengths, 1, i + 1), F.lit(0), lambda n, x: n + x) - len(END)
            return F.when(
                t["role"] == "assistant",
                F.struct((end - F.char_length(escaped(t["text"]))).alias("start"), end.alias("end")),
            )

        return F.filter(F.transform("new", span), lambda s: s.isNotNull())

    return cut.select(
        "conv_id", "stretch", "window", (F.size("repeated") + F.size("new")).alias("n_turns"), F.size("repeated").alias("n_repeated"),
        (F.aggregate("repeated", F.lit(0), lambda n, t: n + t["tokens"]) + F.aggregate("new", F.lit(0), lambda n, t: n + t["tokens"])).alias("n_tokens"),
        F.concat(head, F.array_join(F.transform("new", lambda t: t["written"]), "")).alias("formatted"),
        let(F.char_length(head), spans).alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns read back from a window: array of (role, text), unescaped."""
    parts = F.split(formatted, r"<\|end\|>\n")

    def turn(part: Column) -> Column:
        mark = F.instr(part, "|>\n")
        return F.struct(
            unescaped(F.substring(part, F.lit(3), mark - 3)).alias("role"),
            unescaped(F.substring(part, mark + 3, F.char_length(part))).alias("text"),
        )

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_of(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, joined."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def read_back(windows_: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: its new turns in order, loss text and sizes.

    A digest needs a conversation's text in one value, so here, other than in ``windows``, a row is as
    large as a conversation.
    """
    new = windows_.select(
        "conv_id", "stretch", "window", F.col("formatted"), F.slice(turns_of(F.col("formatted")), F.col("n_repeated") + 1, F.col("n_turns")).alias("turns"),
        loss_of(F.col("formatted"), F.col("loss")).alias("loss_text"),
    )
    part = new.select(
        "conv_id", "stretch", "window", F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        "loss_text", F.char_length("formatted").cast("long").alias("chars"),
    )
    whole = part.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("stretch", "window", "said", "loss_text"))).alias("parts"),
    )
    said = F.array_join(F.transform("parts", lambda p: p["said"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["loss_text"]), "")
    return whole.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
