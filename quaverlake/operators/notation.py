"""Comparisons of note sequences and sounding events."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def play_order(measures: DataFrame) -> DataFrame:
    """The measures of each score in the order in which they sound: (score, place, measure).

    measures: (score, measure, opens, closes, ending): repeat signs before and after a
    measure, and the number of the ending that it belongs to (null for none). Every
    repeat is played twice. The order depends on what has been played, so each score is
    walked through; a score is one group.
    """

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("measure")
        score, m = pdf.score.iloc[0], pdf.to_dict("records")
        order, start, turn, k = [], 0, 1, 0
        while k < len(m):
            row = m[k]
            if row["opens"] and k > start and turn == 1:
                start = k
            ending = row["ending"]
            if not pd.isna(ending) and int(ending) != turn:
                k += 1
                continue
            order.append(row["measure"])
            if row["closes"] and turn == 1:
                turn, k = 2, start
                continue
            if turn == 2 and (row["closes"] or (not pd.isna(ending) and (k + 1 == len(m) or pd.isna(m[k + 1]["ending"])))):
                turn, start = 1, k + 1
            k += 1
        return pd.DataFrame({"score": score, "place": range(len(order)), "measure": order})

    return measures.groupBy("score").applyInPandas(walk, "score string, place long, measure long")


def merge_ties(notes: DataFrame) -> DataFrame:
    """Tied notes as one: islands of notes of one (id, staff, voice, pitch) that follow each other by ties.

    notes: (id, staff, voice, pitch, start, stop, tied) with ``tied`` on each note that goes on
    from the one before.
    """
    w = W.partitionBy("id", "staff", "voice", "pitch").orderBy("start")
    goes_on = F.col("tied") & (F.lag("stop").over(w) == F.col("start"))
    island = F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(w)
    keys = ["id", "staff", "voice", "pitch"]
    return notes.withColumn("_n", island).groupBy(*keys, "_n").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_n")


def compare_views(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per id whether two pitch sequences are exact, shifted by constant octaves, or different.

    a and b: (id, ordinal, pitch). They are joined by place; no sequence is gathered.
    """
    place = W.partitionBy("id").orderBy("ordinal")
    left = a.select("id", F.row_number().over(place).alias("k"), F.col("pitch").alias("p"))
    right = b.select("id", F.row_number().over(place).alias("k"), F.col("pitch").alias("q"))
    both = left.join(right, ["id", "k"], "full").withColumn("d", F.col("q") - F.col("p"))
    whole = both.groupBy("id").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count("d").alias("n"), F.count(F.lit(1)).alias("all"))
    view = F.when((F.col("n") < F.col("all")) | (F.col("lo") != F.col("hi")), "different").when(F.col("lo") == 0, "exact")
    return whole.select("id", view.when(F.col("lo") % 12 == 0, "octave").otherwise("different").alias("view"))


def sounding_programs(events: DataFrame) -> DataFrame:
    """Each note-on with the program then set on its channel, and whether another track set one at that very tick."""
    w = W.partitionBy("id", "channel").orderBy("tick", "track", "ordinal").rowsBetween(W.unboundedPreceding, 0)
    at = W.partitionBy("id", "channel", "tick")
    tracks = F.size(F.collect_set(F.when(F.col("kind").isin("program", "on"), F.col("track"))).over(at))
    out = events.withColumn("sounding", F.coalesce(F.last("program", ignorenulls=True).over(w), F.lit(0)))
    unclear = F.max((F.col("kind") == "program").cast("int")).over(at).cast("boolean") & (tracks > 1)
    return out.withColumn("unclear", unclear).where("kind = 'on'").select("id", "track", "ordinal", "tick", "channel", "pitch", F.col("sounding").alias("program"), "unclear")


def explain_programs(written: Column, sounding: Column) -> Column:
    """Why the program heard may differ from the one written: same, unset, same family of eight, or different."""
    return (
        F.when(written == sounding, "same").when(sounding.isNull() | (sounding == 0), "unset").when(F.floor(written / 8) == F.floor(sounding / 8), "family").otherwise("different")
    )
