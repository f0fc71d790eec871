"""Chat formatting in budgeted windows, with DataFrame functions only.

A turn is written as ``<|role|>`` + line feed + text + ``<|end|>`` + line feed. In roles and texts ``%`` becomes
``%25`` and ``<|`` becomes ``%3C|`` (in roles also the line feed ``%0A`` and ``|>`` ``|%3E``), which is undone in the
reverse order, so no text can write or break a mark.

Prefix sums of the turns' tokens (words and one for the mark) choose the spans: of what the budget leaves beside the
system turn and the history, half is the step of a grid, and the turns that start in the same step are a span. A span
of turns no longer than a step fits the budget; a longer turn is never cut and makes its window longer. A window is
the system turn (a first turn of that role), the history (earlier turns that start at most ``history`` tokens before
the span) and the span. The loss mask holds the assistant's texts of the span, not the repeated ones, so every one of
them is learned once.

Turns are ordered by turn (null first), role and text; a null role or text is empty. Conversations with a null conv_id
are one conversation. Repeated rows are turns of their own. Empty tables give no windows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import WORD

BUDGET = 1024
HISTORY = 128
ASSISTANT, SYSTEM = "assistant", "system"
_BEGIN, _CLOSE, _END = "<|", "|>\n", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\n"), F.lit("%0A")), F.lit("|>"), F.lit("|%3E"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("|%3E"), F.lit("|>")), F.lit("%0A"), F.lit("\n")))


def turns(conversations: DataFrame, budget: int, history: int) -> DataFrame:
    """Every turn with its place, the tokens before it, whether it is the system turn, the step of the grid and span."""
    rows = conversations.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(WORD)).cast("bigint") + 1)
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.select("*", F.row_number().over(order).alias("place"),
                       (F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
                        - F.col("tokens")).alias("before"))
    rows = rows.withColumn("is_system", (F.col("place") == 1) & (F.col("role") == SYSTEM))
    own = F.sum(F.when(F.col("is_system"), F.col("tokens")).otherwise(F.lit(0))).over(Window.partitionBy("conv"))
    rows = rows.withColumn("step", F.greatest(F.floor((budget - history - own) / 2), F.lit(1)))
    return rows.withColumn("span", F.expr("before div step"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window (from 0), formatted text, n_tokens, n_repeated (turns at the front that are no new ones), loss
    (character ranges of ``formatted`` under the mask, from 0, end not included)."""
    rows = turns(conversations, budget, history)
    spans = rows.groupBy("conv", "span").agg(F.min("before").alias("start"))
    # A turn may be history in the steps that start up to `history` tokens after it.
    later = F.sequence(F.col("span"), F.expr(f"(before + {history}) div step"))
    placed = rows.withColumn("own", F.col("span")).withColumn("span", F.explode(later))
    near = (placed.join(spans, ["conv", "span"])
            .where((F.col("own") == F.col("span"))
                   | (~F.col("is_system") & (F.col("start") - F.col("before") <= history))))
    system = (rows.where("is_system").withColumn("own", F.col("span")).drop("span")
              .join(spans.where("span > 0"), "conv"))
    columns = ["conv_id", "conv", "span", "own", "place", "role", "text", "tokens"]
    every = near.select(columns).unionByName(system.select(columns))
    body = escape(F.col("text"))
    head = F.concat(F.lit(_BEGIN), _escape_role(F.col("role")), F.lit(_CLOSE))
    fresh = F.col("own") == F.col("span")
    every = every.select(
        "conv_id", "conv", "span", "place", "tokens", (~fresh).alias("repeated"),
        F.concat(head, body, F.lit(_END)).alias("written"), F.char_length(head).alias("head"),
        F.when(fresh & (F.col("role") == ASSISTANT), F.char_length(body)).alias("learned"))
    ordered = Window.partitionBy("conv", "span").orderBy("place")
    every = every.withColumn("at", F.coalesce(F.sum(F.char_length("written")).over(
        ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("head"))
    loss = F.when(F.col("learned").isNotNull(), F.struct(
        F.col("at").cast("bigint").alias("from"), (F.col("at") + F.col("learned")).cast("bigint").alias("to")))
    pieces = F.array_sort(F.collect_list(F.struct("place", "written")))
    made = every.groupBy("conv_id", "conv", "span").agg(
        F.array_join(F.transform(pieces, lambda x: x["written"]), "").alias("formatted"),
        F.sum("tokens").alias("n_tokens"), F.count_if("repeated").alias("n_repeated"),
        F.array_sort(F.collect_list(loss)).alias("loss"))
    numbered = F.row_number().over(Window.partitionBy("conv").orderBy("span")) - 1
    return made.select("conv_id", numbered.alias("window"), "formatted", "n_tokens", "n_repeated", "loss")


def read_back(made: DataFrame) -> DataFrame:
    """Of every conversation what its windows hold: turns (role and text, once each, in order) and learned (texts)."""
    written = F.split("formatted", r"<\|end\|>\n", -1)
    fresh = F.slice(written, F.col("n_repeated").cast("int") + 1,
                    F.greatest(F.size(written) - 1 - F.col("n_repeated").cast("int"), F.lit(0)))

    def parsed(turn: Column) -> Column:
        mark = F.instr(turn, _CLOSE)
        return F.struct(_unescape_role(F.substring(turn, F.lit(3), mark - 3)).alias("role"),
                        unescape(F.substring(turn, mark + len(_CLOSE), F.char_length(turn))).alias("text"))

    learned = F.transform("loss", lambda x: unescape(F.substring(
        F.col("formatted"), (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int"))))
    parts = made.select("conv_id", F.struct(
        "window", F.transform(fresh, parsed).alias("turns"), learned.alias("learned"),
        F.char_length("formatted").cast("bigint").alias("n_chars")).alias("part"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select(
        "conv_id", F.flatten(F.transform("parts", lambda p: p["turns"])).alias("turns"),
        F.flatten(F.transform("parts", lambda p: p["learned"])).alias("learned"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["n_chars"]).alias("formatted_chars"))


def digests(made: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of every conversation."""
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return read_back(made).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(listed.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")
