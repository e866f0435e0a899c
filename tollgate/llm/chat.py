"""Chat formatting into budgeted, turn-aligned windows (DataFrame functions only).

Turn lengths are summed up along each conversation; a fold over these prefix
sums cuts it into windows whose new turns fit the budget left by the system
turn and the history allowance.  A turn that alone exceeds it gets a window of
its own, whole.  Every later window starts with the system turn and with the
last turns before it, as many as the allowance holds; these repeats are masked,
so each assistant text is a training target exactly once.

Template: ``<|im_start|>role\\n text <|im_end|>\\n``.  Inside texts one backslash
is added to every ``<``, backslashes, ``|`` run, so that no control string can
appear and removing one backslash restores the text.

Defined results: null role or text is empty; ties in ``turn`` are ordered by
role, then text; repeated turns are turns; a null conversation id is one
conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
#: Budgets in estimated tokens of four characters.
BUDGET = 1024
HISTORY = 256
CHARS_PER_TOKEN = 4
_LEAST = (len(START) + 1 + len(END)) // CHARS_PER_TOKEN


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<|"), F.lit("%3C|"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%3C|"), F.lit("<|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def windows(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text", budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, formatted, mask (array of 0-based start and
    length of the target texts, in code points), n_repeated (leading turns that repeat)."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"),
        F.concat(F.lit(START), escape_role(who), F.lit("\n")).alias("head"), escape(said).alias("body"))
    rows = rows.withColumn("tokens", F.ceil((F.length("head") + F.length("body") + len(END)) / CHARS_PER_TOKEN))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    rows = (rows.withColumn("past", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("at", F.row_number().over(order)))
    talk = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("at", "past", "tokens", "role", "head", "body"))).alias("turns"))
    first = F.get("turns", F.lit(0))
    talk = talk.withColumn("system", F.when(first["role"] == "system", first["tokens"]).otherwise(0))
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.col("system"))

    # Fold over prefix sums: a window ends before the first turn that overflows it.
    def step(acc, t):
        before = t["past"] - t["tokens"]
        cut = (t["past"] - acc["base"] > room) & (before > acc["base"])
        return F.struct(F.when(cut, before).otherwise(acc["base"]).alias("base"),
                        F.when(cut, F.concat(acc["starts"], F.array(t["at"]))).otherwise(acc["starts"]).alias("starts"))

    starts = F.aggregate("turns", F.struct(F.lit(0).cast("long").alias("base"), F.array(F.lit(1)).alias("starts")), step)["starts"]
    talk = talk.withColumn("starts", starts)

    def window(start, k):
        stop = F.coalesce(F.get(F.col("starts"), k + 1), F.size("turns") + 1)
        fresh = F.slice("turns", start, stop - start)
        low = F.greatest(F.when(F.col("system") > 0, 2).otherwise(1), start - history // _LEAST - 1)
        past = F.get("turns", start - 2)["past"]
        again = F.when(start > low, F.filter(F.slice("turns", low, F.greatest(start - low, F.lit(0))),
                                             lambda t: past - t["past"] + t["tokens"] <= history)).otherwise(F.slice("turns", 1, 0))
        system = F.slice("turns", 1, F.when((F.col("system") > 0) & (start > 1), 1).otherwise(0))
        return F.struct(k.alias("window"), F.concat(system, again, fresh).alias("turns"),
                        (F.size(system) + F.size(again)).alias("n_repeated"))

    parts = talk.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.*")

    def place(acc, t):
        size, head = F.length(t["body"]), F.length(t["head"])
        target = (t["role"] == "assistant") & (acc["i"] >= F.col("n_repeated"))
        return F.struct((acc["at"] + head + size + len(END)).alias("at"), (acc["i"] + 1).alias("i"),
                        F.when(target, F.concat(acc["mask"], F.array(F.struct((acc["at"] + head).alias("start"), size.alias("length")))))
                        .otherwise(acc["mask"]).alias("mask"))

    mask = F.aggregate("turns", F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"),
                                         F.array().cast("array<struct<start:int,length:int>>").alias("mask")), place)["mask"]
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return parts.select("conv_id", "window", formatted.alias("formatted"), mask.alias("mask"), "n_repeated")


def parse(formatted: Column) -> Column:
    """Turns (role, text) of a formatted window, unescaped."""
    whole = F.split(formatted, r"<\|im_end\|>\n", -1)
    inner = F.transform(F.slice(whole, 1, F.greatest(F.size(whole) - 1, F.lit(0))), lambda s: F.substring(s, F.lit(len(START) + 1), F.length(s)))
    return F.transform(inner, lambda s: F.struct(
        unescape_role(F.substring_index(s, "\n", 1)).alias("role"),
        unescape(F.substring(s, F.length(F.substring_index(s, "\n", 1)) + 2, F.length(s))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest per conversation of the turns and targets that the windows hold."""
    new = F.slice("said", F.col("n_repeated") + 1, F.greatest(F.size("said") - F.col("n_repeated"), F.lit(0)))
    rows = (formatted.withColumn("said", parse(F.col("formatted"))).withColumn("new", new)
            .select("conv_id", "window", F.size("new").alias("n"), F.length("formatted").alias("chars"),
                    F.array_join(F.transform("new", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
                    F.array_join(F.transform("mask", lambda m: unescape(
                        F.substring(F.col("formatted"), m["start"] + 1, m["length"]))), "").alias("loss")))
    parts = F.sort_array(F.collect_list(F.struct("window", "turns", "loss")))
    whole = (rows.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"), parts.alias("parts"))
             .select("conv_id", "n_turns", "formatted_chars",
                     F.array_join(F.col("parts.turns"), "").alias("turns"), F.array_join(F.col("parts.loss"), "").alias("loss")))
    return whole.select("conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"),
                        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
