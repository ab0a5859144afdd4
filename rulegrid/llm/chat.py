"""Chat formatting in budgeted, turn-aligned windows; DataFrame functions only.

Turns are ordered by ``turn``, then role and text.  Running sums of turn tokens (words plus ``MARKS``) choose the windows: a new
window starts with the first turn that begins at or after the next multiple of ``stride`` tokens, so windows hold whole turns.
Each window also repeats

* the conversation's first system turn, and
* the turns just before it that begin at most ``history`` tokens before its start.

Under the loss mask are the texts of assistant turns in the window where they are new; repeated ones are masked, so every
assistant text is a target exactly once.  A window holds at most stride + history tokens, its system turn and the overhang of its last turn.

Template: ``<s>``, then for each turn ``[INST]`` role, line feed, text ``[/INST]``, then ``</s>``.  In roles and texts ``\\`` becomes ``\\e``,
``<`` becomes ``\\l`` and ``[`` becomes ``\\b``; as all control strings start with one of the latter two, none can occur inside a text, and every
backslash is followed by one of three letters, so the steps can be undone.

Running sums are taken within runs of ``RUN`` turn numbers and then over the runs' totals, so a conversation with very many turns is
spread over tasks.

Results for odd input: a null text or role is empty, a null turn comes first, a null conv_id is a conversation of its own; equal rows are
separate turns; an empty table gives no windows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRIDE, HISTORY, MARKS, RUN = 512, 128, 4, 256

_ENTRY = "struct<place:bigint,role_start:int,role_end:int,start:int,end:int,repeated:boolean,loss:boolean>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")), F.lit("\\e"), F.lit("\\"))


def null_safe_join(a: DataFrame, b: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on equal keys, nulls being equal too; the keys come out once."""
    for k in keys:
        b = b.withColumnRenamed(k, f"_other_{k}")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_other_{k}"))
    return a.join(b, on, how).drop(*[f"_other_{k}" for k in keys])


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with their place in the conversation and the tokens before them."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", F.size(F.split(F.trim("text"), r"\s+")).cast("long") + MARKS).withColumn("run", F.floor(F.col("turn") / RUN))
    within = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "text")
    rows = rows.withColumn("place", F.row_number().over(within).cast("long")).withColumn(
        "before", F.coalesce(F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    )
    over = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    totals = totals.select("conv_id", "run", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n0"), F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t0"))
    joined = null_safe_join(rows, totals, "conv_id", "run")
    return joined.select("conv_id", "role", "text", (F.col("place") + F.col("n0")).alias("place"), (F.col("before") + F.col("t0")).alias("before"))


def format_conversations(turns: DataFrame, stride: int = STRIDE, history: int = HISTORY) -> DataFrame:
    """``(conv_id, window, formatted, turns)`` of ``turns (conv_id, turn, role, text)``; ``turns`` says for each turn in the window
    its place in the conversation, the spans of role and text in ``formatted`` (code points), whether it is repeated and whether it is under the loss mask."""
    rows = _ordered(turns).withColumn("cell", F.floor(F.col("before") / stride))
    starts = rows.groupBy("conv_id", "cell").agg(F.min("before").alias("start"))
    along = Window.partitionBy("conv_id").orderBy("cell")
    starts = starts.withColumn("window", F.row_number().over(along) - 1).withColumn("next", F.lead("start").over(along))
    first_system = rows.where("role = 'system'").groupBy("conv_id").agg(F.min("place").alias("system_place"))
    cells = null_safe_join(starts, first_system, "conv_id", how="left").select("conv_id", "cell", "window", "next", "system_place")
    placed = null_safe_join(rows, cells, "conv_id", "cell")
    is_system = F.coalesce(F.col("place") == F.col("system_place"), F.lit(False))
    again = ~is_system & F.col("next").isNotNull() & (F.col("next") - F.col("before") <= history)
    here = F.struct(F.col("window").alias("w"), F.lit(False).alias("repeated"))
    there = F.struct((F.col("window") + 1).alias("w"), F.lit(True).alias("repeated"))
    entries = placed.select(
        "conv_id", "place", "role", "text", F.explode(F.when(again, F.array(here, there)).otherwise(F.array(here))).alias("e")
    ).select("conv_id", "place", "role", "text", F.col("e.w").alias("window"), F.col("e.repeated").alias("repeated"))
    system = placed.where(is_system).select("conv_id", "place", "role", "text", F.col("window").alias("own"))
    later = cells.select("conv_id", "window")
    kept = null_safe_join(system, later, "conv_id").where("window > own").select("conv_id", "place", "role", "text", "window", F.lit(True).alias("repeated"))
    entry = F.struct("place", escaped(F.col("role")).alias("role"), escaped(F.col("text")).alias("text"), "repeated", (F.col("role") == "assistant").alias("target"))
    windows = entries.unionByName(kept).groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    begin = F.struct(F.lit("<s>").alias("out"), F.array().cast(f"array<{_ENTRY}>").alias("turns"))

    def step(acc: Column, e: Column) -> Column:
        role_start = F.char_length(acc["out"]) + 6
        role_end = role_start + F.char_length(e["role"])
        end = role_end + 1 + F.char_length(e["text"])
        span = F.struct(
            e["place"].alias("place"), role_start.alias("role_start"), role_end.alias("role_end"), (role_end + 1).alias("start"), end.alias("end"),
            e["repeated"].alias("repeated"), (e["target"] & ~e["repeated"]).alias("loss"),
        )
        out = F.concat(acc["out"], F.lit("[INST]"), e["role"], F.lit("\n"), e["text"], F.lit("[/INST]"))
        return F.struct(out.alias("out"), F.concat(acc["turns"], F.array(span.cast(_ENTRY))).alias("turns"))

    done = windows.select("conv_id", F.col("window").cast("long").alias("window"), F.aggregate("entries", begin, step).alias("f"))
    return done.select("conv_id", "window", F.concat("f.out", F.lit("</s>")).alias("formatted"), F.col("f.turns").alias("turns"))


def read_back(windows: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text, loss)`` of every turn, cut out of the formatted windows where it is new, and unescaped."""

    def cut(start: str, end: str) -> Column:
        return unescaped(F.substring("formatted", F.col(f"t.{start}") + 1, F.col(f"t.{end}") - F.col(f"t.{start}")))

    each = windows.select("conv_id", "formatted", F.explode("turns").alias("t")).where("not t.repeated")
    return each.select("conv_id", F.col("t.place").alias("place"), cut("role_start", "role_end").alias("role"), cut("start", "end").alias("text"), F.col("t.loss").alias("loss"))
