"""Chat formatting in budgeted windows: turn-aligned spans with the system turn, some history, and a loss mask.

A window reads ``<|turn|>role<|text|>text<|end|>`` for a turn it introduces and ``<|again|>`` instead of
``<|turn|>`` for one it repeats (the system turn, the history). Control strings inside roles and texts get a
backslash after their first character, one more if they already have some, so that reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstar.llm.common import stored

# Control strings of this template and of other common ones.
# <|  <s>  </s>  <<SYS>>  <</SYS>>  [INST]  [/INST]
_ANGLE = r"\\*(?:\||/?s>|</?SYS>>)"
_SQUARE = r"\\*/?INST\]"
TURN, AGAIN, TEXT, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"


def escape(text: Column) -> Column:
    """``text`` with a backslash after the first character of every control string."""
    return F.regexp_replace(text, rf"<(?={_ANGLE})|\[(?={_SQUARE})", r"$0\\")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, rf"(?<=<)\\(?={_ANGLE})|(?<=\[)\\(?={_SQUARE})", "")


def token_count(text: Column) -> Column:
    """Tokens of a turn for the budget: its words, at least one."""
    return F.greatest(F.lit(1), F.size(F.split(F.trim(text), r"\s+"))).cast("long")


def chat_windows(
    turns: DataFrame, budget: int = 512, history: int = 128, target_role: str = "assistant",
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Training windows: ``conv_id, window, n_new, formatted, loss`` (spans of code points, end exclusive).

    Turns are taken in the order of turn, role, text; repeated rows are repeated turns. Null role and text
    count as empty, a null turn comes first, rows with a null conversation form one conversation. A first turn
    of role ``system`` opens every window. With s its tokens, a window introduces the turns whose prefix sum
    lies in the next stretch of c = max(1, (budget - s - history) / 2) tokens, so it keeps the budget unless a
    turn alone is longer than c; such a turn stays whole. Before them it repeats the latest turns that fit in
    ``history`` tokens. The loss mask covers texts of ``target_role`` where they are introduced, never where
    they are repeated. No turns give no windows.

    A conversation may be as long as the table: turns are sorted over all tasks and numbered piece by piece, spans
    and history come from prefix sums without texts, and a text travels only to the windows that show it.
    """
    base = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        *[escape(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(n) for c, n in ((role, "role"), (text, "text"))])
    base = base.withColumn("tokens", token_count(F.col("text"))).withColumn("target", F.col("role") == target_role)
    # Equal rows may be dealt to several tasks; which of them comes first makes no difference.
    order = ["conv_id", "turn", "role", "text", "copy"]
    dealt = base.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    told = stored(dealt.select("conv_id", "role", "text", "tokens", "target", F.monotonically_increasing_id().alias("row")), "chat-turns")
    places = stored(_places(told.select("conv_id", "row", "tokens", (F.col("role") == "system").alias("system")), budget, history), "chat-places")
    shown = _shown(places, history).join(told.select("row", "role", "text", "target"), "row")
    own = F.col("mark") == TURN
    pieces = shown.groupBy("conv", "conv_id", "window").agg(
        F.count_if(own).alias("n_new"),
        F.sort_array(F.collect_list(F.struct("row", "mark", "role", "text", (F.col("target") & own).alias("target")))).alias("pieces"))
    lengths = F.transform("pieces", lambda x: F.char_length(F.concat(x["mark"], x["role"], F.lit(TEXT), x["text"], F.lit(END))))
    measured = pieces.withColumn("ends", _running(lengths))
    tail = len(END)
    spans = F.transform("pieces", lambda x, i: F.when(x["target"], F.struct(
        (F.get("ends", i) - tail - F.char_length(x["text"])).alias("start"), (F.get("ends", i) - tail).alias("end"))))
    formatted = F.array_join(F.transform("pieces", lambda x: F.concat(x["mark"], x["role"], F.lit(TEXT), x["text"], F.lit(END))), "")
    return measured.select("conv_id", "window", "n_new", formatted.alias("formatted"), F.filter(spans, lambda x: x.isNotNull()).alias("loss"))


def _places(rows: DataFrame, budget: int, history: int) -> DataFrame:
    """Of each turn (``conv_id, row, tokens, system``; rows in the order of turns): its conversation (the row of the
    first turn), the tokens before it, its window, the window's tokens and whether it is an opening system turn.

    Sums run inside the pieces that the sort has made of a conversation; the pieces' totals are added after that.
    """
    cut = rows.withColumn("piece", F.shiftright("row", 33))
    pieces = cut.groupBy("conv_id", "piece").agg(
        F.sum("tokens").alias("total"), F.min("row").alias("first"), F.min_by(F.when(F.col("system"), F.col("tokens")), "row").alias("opens"))
    along = Window.partitionBy("conv_id").orderBy("piece")
    before = pieces.select(
        F.col("conv_id").alias("_conv_id"), F.col("piece").alias("_piece"), (F.sum("total").over(along) - F.col("total")).alias("before"),
        F.first("first").over(along).alias("conv"), F.first("opens").over(along).alias("opens"))
    inside = F.sum("tokens").over(Window.partitionBy("conv_id", "piece").orderBy("row")) - F.col("tokens")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("piece") == F.col("_piece"))
    placed = cut.withColumn("inside", inside).join(before, same).withColumn("start", F.col("before") + F.col("inside"))
    # The opening system turn is no history; its tokens come first in the prefix sums of the others.
    s = F.coalesce("opens", F.lit(0))
    opening = F.col("opens").isNotNull() & (F.col("row") == F.col("conv"))
    capacity = F.greatest(F.lit(1), F.floor((F.lit(budget - history) - s) / 2))
    at = F.when(opening, F.lit(0)).otherwise(F.floor((F.col("start") - s) / capacity)).cast("long")
    # The last window that may begin within the reach of this turn as history.
    last = F.floor((F.col("start") + history - s) / capacity).cast("long")
    return placed.select("conv", "conv_id", "row", "start", F.col("opens").isNotNull().alias("opened"), opening.alias("opening"),
                         at.alias("window"), last.alias("last"))


def _shown(places: DataFrame, history: int) -> DataFrame:
    """The turns of every window, ``conv, conv_id, window, row, mark``: its own, its history, the system turn.

    A turn is history of the windows whose first turn starts at most ``history`` tokens later. Those are found by
    an equi-join on the windows that may; a turn reaches at most ``history`` of them.
    """
    columns = ["conv", "conv_id", "window", "row"]
    own = places.select(*columns, F.lit(TURN).alias("mark"))
    windows = places.groupBy("conv", "conv_id", "window", "opened").agg(F.min(F.when(~F.col("opening"), F.col("start"))).alias("begins"))
    reach = places.filter(~F.col("opening") & (F.col("last") > F.col("window"))).select(
        "conv", "row", "start", F.explode(F.sequence(F.col("window") + 1, F.col("last"))).alias("window"))
    near = F.col("begins").between(F.col("start") + 1, F.col("start") + history)
    past = reach.join(windows, ["conv", "window"]).filter(near).select(*columns, F.lit(AGAIN).alias("mark"))
    system = windows.filter(F.col("opened") & (F.col("window") > 0)).select(
        "conv", "conv_id", "window", F.col("conv").alias("row"), F.lit(AGAIN).alias("mark"))
    return own.unionByName(past).unionByName(system)


def _running(lengths: Column) -> Column:
    """Running sums of a short array (a window has at most its budget of turns)."""
    return F.transform(F.sequence(F.lit(1), F.size(lengths)), lambda i: F.aggregate(
        F.slice(lengths, 1, i), F.lit(0).cast("long"), lambda a, x: a + x))


def read_back(windows: DataFrame) -> DataFrame:
    """Conversations read from their windows: ``conv_id, n_turns, turns, loss_text, formatted_chars``.

    ``turns`` is role, line feed, text, line feed for each turn that a window introduces. A conversation's
    turns are joined into one text here, because their digest is asked for.
    """
    parts = F.filter(F.split("formatted", r"<\|end\|>"), lambda x: x.startswith(TURN))
    turns = F.transform(parts, lambda x: F.concat(
        unescape(F.substring_index(F.substr(x, F.lit(len(TURN) + 1)), TEXT, 1)), F.lit("\n"), unescape(F.substring_index(x, TEXT, -1)), F.lit("\n")))
    loss = F.transform("loss", lambda m: unescape(F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    read = windows.select(
        "conv_id", F.struct("window", F.array_join(turns, "").alias("turns"), F.array_join(loss, "").alias("loss")).alias("part"),
        F.size(parts).cast("long").alias("n"), F.char_length("formatted").cast("long").alias("chars"))
    grouped = read.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("part")).alias("parts"))
    join = lambda f: F.array_join(F.transform("parts", lambda x: x[f]), "")
    return grouped.select("conv_id", "n_turns", join("turns").alias("turns"), join("loss").alias("loss_text"), "formatted_chars")
