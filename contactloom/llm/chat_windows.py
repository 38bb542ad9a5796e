"""Chat formatting in budgeted windows with a loss mask, in DataFrame functions.

Prefix sums of turn tokens place every turn on its conversation's token axis;
the axis is cut at multiples of the room a window has for new turns.  Turns
that lie inside one section share a window, a turn across a cut has its own, so
windows are turn-aligned and, but for single turns that are too long, within
the budget.  Each window begins with the conversation's leading system turn
and with as many of the turns before it as fit the history budget; both are
masked where they are repeated.  A turn is

    <s>role\\ntext\\n</s>

with a backslash put before control strings inside the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.tables import col, stage

# fixed values: control strings of the template and of a common chat format
CONTROLS = r"(</?s>|\[/?INST\]|<</?SYS>>)"
#: what ends a turn
TAIL = "\n</s>"
#: turns whose prefix sums one task makes
BLOCK = 128
#: a window's turns: the retained one, repeated ones, new ones
SYSTEM, AGAIN, FRESH = 0, 1, 2


def escape(text: Column) -> Column:
    """One more backslash before every control string."""
    return F.regexp_replace(text, r"(?<!\\)(\\*+)" + CONTROLS, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<!\\)\\(\\*+)" + CONTROLS, "$1$2")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&"), F.lit("&amp;")), F.lit("\n"), F.lit("&#10;")), F.lit("<"), F.lit("&lt;"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("&lt;"), F.lit("<")), F.lit("&#10;"), F.lit("\n")), F.lit("&amp;"), F.lit("&"))


def _head(role: Column) -> Column:
    return F.concat(F.lit("<s>"), escape_role(role), F.lit("\n"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window: array of (role, text)."""
    parts = F.filter(F.split(formatted, r"(?<!\\)</s>"), lambda x: x != "")
    head = lambda x: F.instr(x, "\n")
    return F.transform(parts, lambda x: F.struct(unescape_role(F.substring(x, F.lit(4), head(x) - 4)).alias("role"), unescape(F.substring(x, head(x) + 1, F.length(x) - head(x) - 1)).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, as an array."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def chat_windows(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", budget: int = 1024, history: int = 256, tokens_col: str | None = None) -> DataFrame:
    """A row per window: ``conv_col``, ``window_start``, ``formatted``, ``n_repeated``, ``loss_spans``.

    ``window_start`` orders the windows of a conversation.  The first
    ``n_repeated`` turns of a window were in earlier ones.  ``loss_spans``,
    array of (start, length) in code points of ``formatted``, covers every
    assistant text exactly once.  Tokens are a quarter of a turn's characters,
    rounded up, unless ``tokens_col`` holds exact counts, which must be
    positive.  A system turn or a turn may exceed the budget by its own length:
    a window's new turns but for a single one take at most the greater of
    ``budget - history`` less the system turn and a quarter of the budget.

    Null texts and roles count as empty, null conversations are one
    conversation, turns with the same number are ordered by role and text;
    repeated rows are turns of their own; an empty table gives no window.  Only
    the named columns are read.  A conversation with very many turns is spread
    over tasks by turn number.  Windows are laid out on numbers alone; texts
    move to be ordered, to join their windows, and to be put together.
    """
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(col(conv_col).alias("c"), col(turn_col).alias("turn"), role.alias("role"), text.alias("text"), *([col(tokens_col).cast("bigint").alias("tokens")] if tokens_col else []))
    rows = rows.withColumn("head", F.length(_head(F.col("role")))).withColumn("body", F.length(escape(F.col("text"))))
    if not tokens_col:
        rows = rows.withColumn("tokens", F.ceil((F.col("head") + F.col("body") + len(TAIL)) / 4).cast("bigint"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK).cast("bigint"))

    # prefix sums within blocks of turns; this table alone has texts, and they are joined back once
    inside = Window.partitionBy("c", "block").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    rows = rows.withColumns({"upto": F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "no": F.row_number().over(inside)})
    rows = stage(rows.drop("turn"), "turns")
    # and over the totals of blocks
    totals = rows.groupBy("c", "block").agg(F.sum("tokens").alias("sum"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("c").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("c").alias("c1"), F.col("block").alias("b1"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    placed = rows.drop("text").join(totals, F.col("c").eqNullSafe(F.col("c1")) & F.col("block").eqNullSafe(F.col("b1")))
    leading = (F.col("no") == 1) & (F.col("n") == 0) & (F.col("role") == "system")
    placed = placed.select("c", "block", "no", "head", "body", "tokens", (F.col("upto") + F.col("sum")).alias("s"), (F.col("role") == "assistant").alias("said"), leading.alias("leading"))
    placed = stage(placed, "placed")

    # the leading system turn is retained; everything else is laid out without it
    system = placed.where("leading").select(F.col("c").alias("c1"), F.col("tokens").alias("sys"), F.col("block").alias("sys_block"), F.col("head").alias("sys_head"), F.col("body").alias("sys_body"))
    laid = placed.where("not leading").join(system.select("c1", "sys"), F.col("c").eqNullSafe(F.col("c1")), "left").drop("c1")
    laid = laid.withColumn("s", F.col("s") - F.coalesce("sys", F.lit(0)))
    laid = laid.withColumn("room", F.greatest(F.lit(budget - history) - F.coalesce("sys", F.lit(0)), F.lit(max(budget // 4, 1))).cast("bigint"))
    laid = laid.withColumns({"ws": F.expr("s div room"), "we": F.expr("(s + tokens - 1) div room")})
    spans = laid.groupBy("c", "ws", "we").agg(F.min("s").alias("p"))

    # a turn is history of the windows that begin after it and near enough; few sections can hold those
    reach = F.least(F.lit(history), F.col("room"))
    near = laid.where(F.col("tokens") <= reach).withColumn("k", F.explode(F.sequence(F.expr("s div room"), F.floor((F.col("s") + reach) / F.col("room")))))
    starts = spans.select(F.col("c").alias("c1"), F.col("ws").alias("ws1"), F.col("we").alias("we1"), "p")
    past = near.join(starts, F.col("c").eqNullSafe(F.col("c1")) & (F.col("k") == F.col("ws1")) & (F.col("p") >= F.col("s") + F.col("tokens")) & (F.col("p") <= F.col("s") + reach))
    # the system turn opens every window, also that of a conversation without another turn
    opened = system.join(spans, F.col("c1").eqNullSafe(F.col("c")), "left").select(F.col("c1").alias("c"), F.coalesce("ws", F.lit(0)).alias("ws"), F.coalesce("we", F.lit(0)).alias("we"), F.lit(-1).cast("bigint").alias("s"), F.col("sys_block").alias("block"), F.lit(1).alias("no"), F.col("sys_head").alias("head"), F.col("sys_body").alias("body"), F.lit(SYSTEM).alias("kind"), F.lit(False).alias("loss"))
    place = ["s", "block", "no", "head", "body"]
    members = laid.select("c", "ws", "we", *place, F.lit(FRESH).alias("kind"), F.col("said").alias("loss"))
    members = members.unionByName(past.select("c", F.col("ws1").alias("ws"), F.col("we1").alias("we"), *place, F.lit(AGAIN).alias("kind"), F.lit(False).alias("loss"))).unionByName(opened)

    said = rows.select(F.col("c").alias("c2"), F.col("block").alias("b2"), F.col("no").alias("n2"), F.concat(_head(F.col("role")), escape(F.col("text")), F.lit(TAIL)).alias("piece"))
    full = members.join(said, F.col("c").eqNullSafe(F.col("c2")) & F.col("block").eqNullSafe(F.col("b2")) & (F.col("no") == F.col("n2")))
    part = F.struct("s", "piece", "head", "body", "kind", "loss")
    windows = full.groupBy("c", "ws", "we").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.min(F.when(F.col("kind") == FRESH, F.col("s"))).alias("start"))
    windows = windows.withColumn("start", F.coalesce("start", F.lit(0)).cast("bigint"))
    step = lambda a, x: F.struct((a["at"] + F.length(x["piece"])).alias("at"), F.when(x["loss"], F.array_append(a["spans"], F.struct((a["at"] + x["head"]).cast("int").alias("start"), x["body"].cast("int").alias("length")))).otherwise(a["spans"]).alias("spans"))
    zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,length:int>>)").alias("spans"))
    repeated = F.size(F.filter("parts", lambda x: (x["kind"] == AGAIN) | ((x["kind"] == SYSTEM) & (F.col("start") > 0))))
    return windows.select(
        F.col("c").alias(conv_col),
        F.col("start").alias("window_start"),
        F.array_join(F.transform("parts", lambda x: x["piece"]), "").alias("formatted"),
        repeated.alias("n_repeated"),
        F.aggregate("parts", zero, step, lambda a: a["spans"]).alias("loss_spans"),
    )
