"""Operator 1: chat formatting in budgeted windows, as built-in expressions only.

Prefix sums of turn tokens place every turn on the token axis of its conversation.  The
axis is cut into cells, and a turn belongs to the cell in which it ends; a turn longer than
a quarter of a window that began in an earlier cell stands alone.  So spans follow from the
sums alone, turn by turn.  Each window repeats the latest system turn before its span and a
limited history; repeated text is outside the loss mask.  A window holds at most ``budget``
tokens, unless a single turn is longer than what the system turn leaves, or the system turns
of the conversation take more than 15 of 16 parts of the budget.

Sums are formed by (conversation, chunk of turns) and then over chunks, and all further
keys are (conversation, cell), so a conversation with most of the rows is spread out.
Templates end every turn with its own control string.  A control string inside a text gets
a backslash after its first character, so marks and texts can be told apart and read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import WORD, table

BUDGET = 1024
HISTORY = 192
CHUNK_TURNS = 256
BLOCK_CELLS = 64
TURN_COST = 4

#: The template's control strings after their first character.
CONTROL = r"/?s>|/?INST\]|/?SYS\]|/?TURN[ \]]"
ENDS = r"(?<=</s>|\[/INST\]|\[/SYS\]|\[/TURN\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<])\\(\\*)({CONTROL})", "$1$2$3")


def turn_head(role: Column) -> Column:
    other = F.concat(F.lit("[TURN "), F.base64(role.cast("binary")), F.lit("] "))
    return F.when(role == "user", "[INST] ").when(role == "system", "[SYS] ").when(
        role == "assistant", ""
    ).otherwise(other)


def turn_tail(role: Column) -> Column:
    return F.when(role == "user", " [/INST]").when(role == "system", " [/SYS]").when(
        role == "assistant", "</s>"
    ).otherwise(" [/TURN]")


def placed(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Every turn with its tokens, place and span.

    Columns conv_id, turn, role, text, tokens, start, cell (width ``step``), alone, step, and
    ``reach``, the tokens of history that the longest system turn leaves room for.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("tokens", F.regexp_count("text", F.lit(WORD)).cast("long") + TURN_COST).withColumn(
        "chunk", F.floor(F.coalesce("turn", F.lit(-1)) / CHUNK_TURNS)
    )
    chunks = rows.groupBy("conv_id", "chunk").agg(
        F.sum("tokens").alias("n"),
        F.max(F.when(F.col("role") == "system", F.col("tokens"))).alias("system"),
    )
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        F.col("conv_id").alias("_conv"), F.col("chunk").alias("_chunk"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max("system").over(whole), F.lit(0)).alias("system"),
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, 0
    )
    summed = rows.withColumn("end", F.sum("tokens").over(inside))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    reach = F.greatest(F.least(F.lit(history), F.floor((F.lit(budget) - F.col("system")) / 4)), F.lit(0))
    room = F.greatest(F.lit(budget) - F.col("system") - reach, F.lit(budget // 16))
    return summed.join(offsets, same).select(
        "conv_id", "turn", "role", "text", "tokens",
        (F.col("before") + F.col("end") - F.col("tokens")).alias("start"),
        (room - F.floor(room / 4)).cast("long").alias("step"), reach.cast("long").alias("reach"),
    ).withColumn(
        "cell", F.floor((F.col("start") + F.col("tokens") - 1) / F.col("step"))
    ).withColumn(
        "alone",
        (F.floor(F.col("start") / F.col("step")) < F.col("cell"))
        & (F.col("tokens") > F.floor(F.col("step") / 3)),
    )


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, formatted, loss.

    ``window`` numbers the spans of a conversation in order (with gaps), the first
    ``n_repeated`` turns are repeated, ``loss`` lists (start, length) in code points of the
    escaped texts under the loss mask.  NULL conversation ids are one conversation, NULL
    turns come first, equal turns are ordered by role and text, repeated rows are turns of
    their own; a NULL text or role is empty; an empty table gives no windows.
    """
    placed_turns = placed(turns, budget, history)
    number = (F.col("cell") * 2 + (~F.col("alone")).cast("long")).alias("window")
    own = placed_turns.select("conv_id", number, "start", "role", "text", "step", "reach")
    spans = own.groupBy("conv_id", "window").agg(
        F.min("start").alias("first"), F.max("step").alias("step"), F.max("reach").alias("reach")
    )
    # history: turns that end before a span and lie within the allowed tokens before it
    cells = F.explode(
        F.sequence(
            F.floor(F.greatest(F.col("first") - F.col("reach"), F.lit(0)) / F.col("step")),
            F.floor(F.greatest(F.col("first") - 1, F.lit(0)) / F.col("step")),
        )
    ).alias("_cell")
    looking = spans.where("first > 0").select(F.col("conv_id").alias("_conv"), "window", "first", "reach", cells)
    told = placed_turns.where("role != 'system'").select("conv_id", "cell", "start", "tokens", "role", "text")
    near = told.join(
        looking,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("cell") == F.col("_cell"))
        & (F.col("start") >= F.col("first") - F.col("reach")) & (F.col("start") + F.col("tokens") <= F.col("first")),
    ).select("conv_id", "window", "start", "role", "text", F.lit(1).alias("kind"))
    systems = placed_turns.where("role = 'system'")
    ruled = with_latest(spans, systems).join(
        systems.select(F.col("conv_id").alias("_conv"), "start", "text"),
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("latest") == F.col("start")),
    ).select(
        "conv_id", "window", F.lit(-1).cast("long").alias("start"), F.lit("system").alias("role"),
        "text", F.lit(0).alias("kind"),
    )
    parts = own.select("conv_id", "window", "start", "role", "text", F.lit(2).alias("kind"))
    parts = parts.unionByName(near).unionByName(ruled)
    said = F.struct(
        "kind", "start", turn_head(F.col("role")).alias("head"), escape(F.col("text")).alias("body"),
        turn_tail(F.col("role")).alias("tail"),
        ((F.col("kind") == 2) & (F.col("role") == "assistant")).alias("loss"),
    )
    listed = parts.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(said)).alias("said"))
    spots = F.aggregate(
        "said",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("found")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + F.length(t["tail"])).alias("at"),
            F.when(
                t["loss"],
                F.concat(
                    acc["found"],
                    F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))),
                ),
            ).otherwise(acc["found"]).alias("found"),
        ),
    )
    return listed.select(
        "conv_id", "window",
        F.size(F.filter("said", lambda t: t["kind"] < 2)).alias("n_repeated"),
        F.array_join(F.transform("said", lambda t: F.concat(t["head"], t["body"], t["tail"])), "").alias("formatted"),
        spots["found"].alias("loss"),
    )


def with_latest(spans: DataFrame, systems: DataFrame) -> DataFrame:
    """(conv_id, window, latest): the start of the last system turn before each span that has one.

    First within blocks of cells, then over the blocks of a conversation, so that no task
    orders all spans of a long conversation.
    """
    block = F.floor(F.col("at") / (F.col("step") * BLOCK_CELLS)).alias("block")
    turns = systems.select("conv_id", F.lit(None).cast("long").alias("window"), F.col("start").alias("at"), "step", F.col("start").alias("said"))
    both = spans.select(
        "conv_id", "window", F.col("first").alias("at"), "step", F.lit(None).cast("long").alias("said")
    ).unionByName(turns).select("conv_id", "window", "at", "said", block)
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = both.groupBy("conv_id", "block").agg(F.max("said").alias("last"))
    carried = last.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.max("last").over(before).alias("carried"))
    found = both.withColumn("own", F.max("said").over(inside)).where("window is not null")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    return found.join(carried, same).select(
        "conv_id", "window", F.coalesce("own", "carried").alias("latest")
    ).where("latest is not null")


def read_turns(formatted: Column, n_repeated: Column) -> Column:
    """The turns of a window's own span, read back from its text: (role, text)."""
    marked = F.filter(F.split(formatted, ENDS, -1), lambda t: t != "")

    def turn(t: Column) -> Column:
        def body(head: str, tail: str) -> Column:
            return unescape(F.regexp_extract(t, rf"(?s)^{head}(.*){tail}$", 1))

        return (
            F.when(t.endswith("[/INST]"), F.struct(F.lit("user").alias("role"), body(r"\[INST\] ", r" \[/INST\]").alias("text")))
            .when(t.endswith("[/SYS]"), F.struct(F.lit("system").alias("role"), body(r"\[SYS\] ", r" \[/SYS\]").alias("text")))
            .when(t.endswith("</s>"), F.struct(F.lit("assistant").alias("role"), body("", "</s>").alias("text")))
            .otherwise(
                F.struct(
                    F.unbase64(F.regexp_extract(t, r"^\[TURN ([^\]]*)\] ", 1)).cast("string").alias("role"),
                    body(r"\[TURN [^\]]*\] ", r" \[/TURN\]").alias("text"),
                )
            )
        )

    return F.transform(F.slice(marked, n_repeated + 1, F.greatest(F.size(marked) - n_repeated, F.lit(0))), turn)


def loss_texts(formatted: Column, loss: Column) -> Column:
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, from nothing but its windows."""
    turns = read_turns(F.col("formatted"), F.col("n_repeated"))
    parts = formatted.select(
        "conv_id", "window", F.length("formatted").alias("chars"), turns.alias("turns"),
        F.array_join(loss_texts(F.col("formatted"), F.col("loss")), "").alias("loss"),
    ).select(
        "conv_id", "chars", F.size("turns").alias("n"),
        F.struct(
            "window",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            "loss",
        ).alias("part"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
        F.sort_array(F.collect_list("part")).alias("parts"),
    )
    loss = F.array_join("parts.loss", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("parts.turns", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(windows(turns.unionByName(planted)))


ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), a AS (
  SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + {TURN_COST} AS n FROM t
), b AS (
  SELECT *, row_number() OVER w AS k, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) - n AS s,
    coalesce(max(n) FILTER (role = 'system') OVER (PARTITION BY conv_id), 0) AS sys
  FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), r AS (SELECT *, greatest(least({HISTORY}, cast(floor(({BUDGET} - sys) / 4) as bigint)), 0) AS reach FROM b
), o AS (SELECT *, greatest({BUDGET} - sys - reach, {BUDGET // 16}) AS room FROM r
), c AS (SELECT *, room - room // 4 AS step FROM o
), d AS (SELECT *, (s + n - 1) // step AS cell FROM c
), e AS (
  SELECT *, cell * 2 + CASE WHEN s // step < cell AND n > step // 3 THEN 0 ELSE 1 END AS win,
    length(regexp_replace(text, '([\[<])(\\*)(/?s>|/?INST\]|/?SYS\]|/?TURN[ \]])', '\1\\\2\3', 'g'))
      + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 4
        ELSE 16 + length(base64(encode(role))) END AS chars
  FROM d
), f AS (SELECT conv_id, win, min(s) AS first FROM e GROUP BY ALL
), g AS (
  SELECT f.conv_id, sum(e.chars) AS chars FROM f JOIN e ON e.conv_id = f.conv_id AND e.role <> 'system'
    AND e.s >= f.first - e.reach AND e.s + e.n <= f.first GROUP BY ALL
), l AS (
  SELECT f.conv_id, f.win, arg_max(e.chars, e.s) AS chars FROM f
  JOIN e ON e.conv_id = f.conv_id AND e.role = 'system' AND e.s < f.first GROUP BY ALL
), h AS (SELECT conv_id, sum(chars) AS chars FROM l GROUP BY ALL
), z AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
    coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss, sum(chars) AS chars
  FROM e GROUP BY conv_id
)
SELECT z.conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  (z.chars + coalesce(g.chars, 0) + coalesce(h.chars, 0))::BIGINT AS formatted_chars
FROM z LEFT JOIN g ON g.conv_id = z.conv_id LEFT JOIN h ON h.conv_id = z.conv_id
"""
