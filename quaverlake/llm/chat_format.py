r"""Chat formatting with budgeted windows.

Every turn of a conversation is rendered between ``<s>[INST] role`` and ``</s>``;
texts are escaped so that no control string can occur inside them. Prefix sums of
the turns' tokens cut a conversation into turn-aligned spans. The budget less the
system turn's and the history's tokens is the cell of a grid over the prefix sums: the
turns that lie whole in one cell are a span, and a turn that crosses a cell's end is one
alone. A window is a span with the system turn before it and those last turns of history
whose tokens fit the history budget; a long turn that leaves no room for it has none. So
no window has more tokens than the budget, unless the system turn and one further turn
have more. The loss mask covers the assistant texts of the span only; those repeated as history or as
system turn are masked out, so each target is learned once.

Escape: a backslash is doubled, and a backslash goes between the first and second
character of every control string. Unescaping drops each backslash that stands
before a character and keeps that character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

START, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
#: A token is a run of ASCII letters and digits, or one other visible character.
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r]"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(/?(?:s>|INST\]))", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def windows(conversations: DataFrame, budget: int = 256, history: int = 64) -> DataFrame:
    """Formats conversations (conv_id, turn, role, text); one row per window.

    Returns conv_id, window, formatted, n_repeated (leading turns that are repeated
    context) and loss (array of (start, length) in code points of ``formatted``, from
    1). A null text or role counts as empty. Turns of equal number are ordered by
    role and text; repeated rows are turns of their own. A window's texts have ``budget``
    tokens at most, but for one whose only turn, or that and the system turn, has more. Rows with a null conv_id form one conversation. An empty
    table gives an empty result; other columns are ignored.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = turns.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long"))
    turns = turns.withColumn("pos", F.row_number().over(order)).withColumn(
        "before", F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("tokens")
    )
    system = (F.col("pos") == 1) & (F.col("role") == "system")
    whole = W.partitionBy("conv_id")
    turns = turns.withColumn("own_system", system).withColumn("ahead", F.sum(F.when(system, F.col("tokens")).otherwise(0)).over(whole))
    # The grid counts the tokens after the system turn, which every window holds.
    turns = turns.withColumn("before", F.when(system, 0).otherwise(F.col("before") - F.col("ahead")))
    turns = turns.withColumn("room", F.lit(budget) - F.col("ahead"))
    back = F.col("room") >= 2 * history
    turns = turns.withColumn("back", back).withColumn("cell", F.greatest(F.lit(1), F.col("room") - F.when(back, history).otherwise(0)))
    turns = turns.withColumn("at", F.expr("before div cell"))
    crosses = ~system & F.expr("tokens > 0 and (before + tokens - 1) div cell > at")
    has_history = F.col("back") & (~crosses | (F.col("tokens") + history <= F.col("room")))
    # Windows in order: of a cell the span inside it, then the turn that crosses its end; odd ones have no history.
    own = F.col("at") * 4 + F.when(crosses, 2).otherwise(0) + F.when(has_history, 0).otherwise(1)
    # Beside a system turn that leaves little room each turn is a span.
    turns = turns.withColumn("own", F.when(F.col("room") < budget // 4, F.col("pos") * 4 + 1).otherwise(own).cast("long"))
    # A turn is history up to the window that begins at most ``history`` tokens after the turn's begin.
    ahead = W.partitionBy("conv_id").orderBy("before").rangeBetween(0, history)
    reach = F.when(system, F.max("own").over(whole)).otherwise(F.max("own").over(ahead))
    placed = turns.withColumn("reach", reach).withColumn("window", F.explode(F.sequence("own", F.greatest("own", "reach"))))
    placed = placed.where(F.col("own_system") | (F.col("own") == F.col("window")) | (F.col("window") % 2 == 0))
    start = F.concat(F.lit(f"{START}{OPEN} "), escape(F.col("role")), F.lit(f" {CLOSE}"))
    placed = placed.select(
        "conv_id",
        "window",
        F.struct(
            "pos",
            (F.col("own") == F.col("window")).alias("own"),
            (F.col("role") == "assistant").alias("target"),
            start.alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("t"),
    )
    grouped = placed.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list("t")).alias("t"))
    grouped = grouped.where(F.exists("t", lambda t: t["own"]))  # cells without a span
    pieces = F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    # Offsets of the turns in the window, then the spans of the targets.
    step = F.aggregate(
        "t",
        F.struct(F.lit(1).cast("long").alias("at"), F.expr("array()").cast("array<struct<start:bigint,length:bigint>>").alias("loss")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + F.lit(len(END))).alias("at"),
            F.when(
                t["own"] & t["target"],
                F.concat(
                    acc["loss"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(t["head"])).alias("start"),
                            F.length(t["body"]).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["loss"])
            .alias("loss"),
        ),
    )
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(pieces, "").alias("formatted"),
        F.size(F.filter("t", lambda t: ~t["own"])).alias("n_repeated"),
        step["loss"].alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Reads windows back: one row per conversation with its turns and its loss text.

    Returns conv_id, n_turns, turns (role, newline, text, newline per turn), loss and
    formatted_chars.
    """
    pieces = F.split("formatted", END, -1)
    pieces = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))

    def turn(piece: Column) -> Column:
        body = F.substring_index(piece, CLOSE, -1)
        role = F.substr(
            piece, F.lit(len(START + OPEN) + 2),
            F.length(piece) - F.length(body) - F.lit(len(START + OPEN + CLOSE) + 2),
        )
        return F.concat(unescape(role), F.lit("\n"), unescape(body), F.lit("\n"))

    each = formatted.select(
        "conv_id",
        F.struct(
            "window",
            F.size(pieces).cast("long").alias("n"),
            F.array_join(F.transform(pieces, turn), "").alias("turns"),
            F.array_join(
                F.transform(
                    "loss",
                    lambda s: unescape(F.substr("formatted", s["start"].cast("int"), s["length"].cast("int"))),
                ),
                "",
            ).alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        ).alias("w"),
    )
    whole = each.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    total = lambda name: F.aggregate("w", F.lit(0).cast("long"), lambda acc, w: acc + w[name])
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.array_join(F.transform("w", lambda w: w["turns"]), "").alias("turns"),
        F.array_join(F.transform("w", lambda w: w["loss"]), "").alias("loss"),
        total("chars").alias("formatted_chars"),
    )


def op4_chat_format(spark, sf_dir):
    own = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '{own}' AS text "
        f"UNION ALL SELECT -1L, 1L, 'assistant', '{own}'"
    )
    rows = common.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    back = read_back(windows(rows.unionByName(extra)))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _sql(budget: int = 256, history: int = 64) -> str:
    esc = (
        "regexp_replace(replace({0}, '\\', '\\\\'), '([<\\[])(/?(?:s>|INST\\]))', '\\1\\\\\\2', 'g')"
    )
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), n AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9 \\t\\n\\r]'))::BIGINT AS tokens,
         row_number() OVER w AS pos
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), b AS (
  SELECT *, (sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos) - tokens)::BIGINT AS before,
         pos = 1 AND role = 'system' AS is_system,
         coalesce(sum(tokens) FILTER (pos = 1 AND role = 'system') OVER (PARTITION BY conv_id), 0)::BIGINT AS ahead,
         length('<s>[INST] ' || {esc.format('role')} || ' [/INST]' || {esc.format('text')} || '</s>') AS chars
  FROM n
), r AS (
  SELECT * REPLACE (CASE WHEN is_system THEN 0 ELSE before - ahead END AS before), {budget} - ahead AS room FROM b
), o AS (
  SELECT *, greatest(1, CASE WHEN room >= {2 * history} THEN room - {history} ELSE room END) AS cell FROM r
), k AS (
  SELECT *, before // cell AS slot,
         NOT is_system AND tokens > 0 AND (before + tokens - 1) // cell > before // cell AS alone FROM o
), q AS (
  SELECT *, CASE WHEN room < {budget // 4} THEN pos * 4 + 1 ELSE slot * 4 + CASE WHEN alone THEN 2 ELSE 0 END
         + CASE WHEN room >= {2 * history} AND (NOT alone OR tokens + {history} <= room) THEN 0 ELSE 1 END END AS own FROM k
), v AS (
  SELECT conv_id, own AS win, min(before) AS start FROM q GROUP BY ALL
), f AS (
  SELECT q.conv_id, sum(chars)::BIGINT AS formatted_chars
  FROM q JOIN v ON q.conv_id IS NOT DISTINCT FROM v.conv_id
       AND (q.own = v.win OR is_system OR (v.win % 2 = 0 AND q.own < v.win AND q.before >= v.start - {history}))
  GROUP BY q.conv_id
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS turns,
         coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss
  FROM n GROUP BY conv_id
)
SELECT g.conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM g JOIN f ON g.conv_id IS NOT DISTINCT FROM f.conv_id
"""


OP4_SQL = _sql()
