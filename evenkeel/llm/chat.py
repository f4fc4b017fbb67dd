r"""Chat formatting in budgeted windows.

A turn is written ``<|turn:ROLE|>TEXT<|end|>``, the role percent-encoded. Inside texts
a control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) gets a backslash
after its first character, and one more where backslashes already stand there; so no
text holds a mark, and taking one backslash away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenkeel.llm.common import let

BUDGET = 1024
HISTORY_TOKENS = 192
#: Turns before a window that it may repeat.
HISTORY_TURNS = 2
#: Bytes of a formatted turn that count as one token.
TOKEN_BYTES = 4

END = "<|end|>"
CONTROL = r"(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, r"$1$2$3")


def header(role: Column) -> Column:
    return F.concat(F.lit("<|turn:"), F.url_encode(role), F.lit("|>"))


def format_conversations(turns: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
                         token_bytes: int = TOKEN_BYTES) -> DataFrame:
    """One row per window: conv_id, window (from 0), formatted, loss, n_repeated, n_turns,
    n_tokens, ``oversized``.

    Prefix sums of turn tokens cut a conversation into cells of three quarters of the
    room (the budget less history and system turn); a window is the turns that begin in
    a cell. The turn that crosses a cell's end stays if all fit, else it is a window of
    its own. So windows keep to the budget unless a single turn is longer than the room
    (``oversized``; turns are never cut). Each window repeats the conversation's first
    system turn if that came before, then up to ``HISTORY_TURNS`` turns right before it
    if they fit ``history_tokens``. ``loss`` lists (start, length), in code points of
    ``formatted``, of the texts of assistant turns that are not repeats: every one is
    learnt once. ``n_repeated`` turns stand in front of a window's own.

    Turns are ordered by turn (null first), then role and text; null role and text are
    empty, rows with a null conv_id are one conversation. Repeated rows are turns of
    their own. Other columns are not read. An empty table gives no rows. A conversation
    is ordered in one task, which streams it; what is gathered is one window.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    head, body = header(F.col("role")), escape(F.col("text"))
    blocks = rows.select(
        "conv_id", "turn", "role", "text", F.concat(head, body, F.lit(END)).alias("block"),
        F.when(F.col("role") == "assistant", F.struct(F.length(head).alias("start"), F.length(body).alias("length"))
               ).alias("loss"))
    ordered = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto, whole = ordered.rowsBetween(W.unboundedPreceding, 0), ordered.rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)
    sized = blocks.withColumn("tokens", F.ceil(F.octet_length("block") / token_bytes))
    summed = sized.withColumns({"upto": F.sum("tokens").over(upto), "at": F.row_number().over(ordered)})
    system = F.first(F.when(F.col("role") == "system", F.struct("at", "tokens", "block")), ignorenulls=True)
    placed = summed.withColumn("system", system.over(W.partitionBy("conv_id").orderBy("at").rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)))
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - F.coalesce("system.tokens", F.lit(0)))
    cells = placed.withColumn("room", room).withColumn("stride", F.greatest(F.lit(1), F.floor(F.col("room") * 3 / 4))
                              ).withColumn("before", F.col("upto") - F.col("tokens")
                              ).withColumn("cell", F.floor(F.col("before") / F.col("stride")))
    in_cell = W.partitionBy("conv_id", "cell").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    first = F.min("before").over(in_cell)
    alone = ((F.col("upto") > (F.col("cell") + 1) * F.col("stride")) & (F.col("before") > first)
             & (F.col("upto") - first > F.col("room")))
    by_turn = W.partitionBy("conv_id").orderBy("at")
    marked = cells.withColumn("alone", alone)
    key = F.struct("cell", "alone")
    opened = marked.withColumn("opens", F.coalesce(F.lag(key).over(by_turn) != key, F.lit(True)))
    windows = opened.withColumn("window", F.sum(F.col("opens").cast("bigint")).over(
        by_turn.rowsBetween(W.unboundedPreceding, 0)) - 1)
    is_system = F.col("at") == F.col("system.at")
    windows = windows.withColumn("system_window", F.max(F.when(is_system, F.col("window"))).over(
        by_turn.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))

    def place(window, at, repeated, block, tokens, loss):
        return F.struct(window.alias("window"), at.cast("bigint").alias("at"), F.lit(repeated).alias("repeated"),
                        block.alias("block"), tokens.alias("tokens"), loss.alias("loss"))

    none = F.lit(None).cast("struct<start: int, length: int>")
    own = place(F.col("window"), F.col("at"), False, F.col("block"), F.col("tokens"), F.col("loss"))
    kept = F.when(F.col("opens") & (F.col("window") > F.col("system_window")), place(
        F.col("window"), F.lit(0), True, F.col("system.block"), F.col("system.tokens"), none))
    history = []
    for j in range(1, HISTORY_TURNS + 1):
        near = F.lead("before", j).over(by_turn) - F.col("before") <= history_tokens
        into = F.lead("window", j).over(by_turn)
        history.append(F.when(F.lead("opens", j).over(by_turn) & near & ~F.coalesce(is_system, F.lit(False)), place(
            into, F.col("at"), True, F.col("block"), F.col("tokens"), none)))
    copies = windows.withColumn("copies", F.array(own, kept, *history)).select(
        "conv_id", F.explode(F.filter("copies", lambda c: c.isNotNull())).alias("c"))
    # room of a window depends on the conversation alone, so it is over only by a single turn
    starts = W.partitionBy("conv_id", "c.window").orderBy("c.at").rowsBetween(W.unboundedPreceding, -1)
    shifted = copies.withColumn("shift", F.coalesce(F.sum(F.length("c.block")).over(starts), F.lit(0)))
    span = F.when(F.col("c.loss").isNotNull(), F.struct(
        (F.col("shift") + F.col("c.loss.start")).alias("start"), F.col("c.loss.length").cast("bigint").alias("length")))
    gathered = shifted.groupBy("conv_id", F.col("c.window").alias("window")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("c.at"), F.col("c.block"), span.alias("span")))).alias("parts"),
        F.sum(F.col("c.repeated").cast("bigint")).alias("n_repeated"), F.count(F.lit(1)).alias("n_turns"),
        F.sum("c.tokens").alias("n_tokens"))
    return gathered.select(
        "conv_id", "window", F.array_join(F.transform("parts", lambda p: p["block"]), "").alias("formatted"),
        F.filter(F.transform("parts", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"),
        "n_repeated", "n_turns", "n_tokens", (F.col("n_tokens") > budget).alias("oversized"))


def read_windows(windows: DataFrame) -> DataFrame:
    """What the formatted text and its loss mask hold: ``own`` (role and text of the turns
    that are not repeats, in order) and ``learnt`` (texts under the mask, in order)."""
    def turn(piece: Column) -> Column:
        mark = F.instr(piece, "|>") if isinstance(piece, str) else F.locate("|>", piece)
        return F.struct(F.url_decode(F.substring(piece, F.lit(8), mark - 8)).alias("role"),
                        unescape(F.substring(piece, mark + 2, F.length(piece))).alias("text"))

    pieces = F.split("formatted", r"<\|end\|>", -1)
    turns = let(pieces, lambda p: F.transform(F.slice(p, F.col("n_repeated").cast("int") + 1, F.greatest(
        F.lit(0), F.size(p) - 1 - F.col("n_repeated").cast("int"))), turn))
    learnt = F.transform("loss", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return windows.withColumns({"own": turns, "learnt": learnt})
