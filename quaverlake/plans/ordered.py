"""Queries on order and state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ordered as O
from .registry import query, table


@query("SELECT p_partkey, row_number() OVER (ORDER BY lower(p_name), p_partkey) - 1 AS id FROM part")
def dense_ids(spark, d):
    return O.dense_ids(table(spark, d, "part").select("p_partkey", "p_name"), [F.lower("p_name"), F.col("p_partkey")]).select("p_partkey", "id")


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS signup FROM events""")
def carry_forward(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return O.carry_forward(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "signup").select("event_id", "signup")


@query("""WITH e AS (SELECT *, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS epoch FROM events)
 SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id, epoch ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_view FROM e""")
def carry_forward_with_reset(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    view = F.when(F.col("event_type") == "view", F.col("event_id"))
    return O.carry_forward(e, ["user_id"], ["ts", "event_id"], view, "last_view", reset=F.col("event_type") == "error").select("event_id", "last_view")


@query("""WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS start, floor(epoch(ts))::BIGINT + 600 AS stop FROM events),
 n AS (SELECT *, CASE WHEN start <= max(stop) OVER (PARTITION BY user_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1800 THEN 0 ELSE 1 END AS new FROM e),
 i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM n)
 SELECT user_id, min(start) AS start, max(stop) AS stop, count(*) AS parts FROM i GROUP BY user_id, island""")
def interval_merge(spark, d):
    s = F.unix_timestamp("ts")
    e = table(spark, d, "events").select("user_id", s.alias("start"), (s + 600).alias("stop"))
    return O.merge_intervals(e, ["user_id"], "start", "stop", 1800)


@query("""SELECT o_orderkey FROM (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE o_orderdate < before""")
def sortedness_check(spark, d):
    return O.unsorted_rows(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], ["o_orderkey"], "o_orderdate").select("o_orderkey")


@query("""WITH p AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 9 = 4 THEN lower(p_name) || '-' || (p_partkey - 1) ELSE p_name END AS n0 FROM part),
 a AS (SELECT k, CASE WHEN count(*) OVER (PARTITION BY lower(n0)) > 1 THEN n0 || '-' || k ELSE n0 END AS n1 FROM p)
 SELECT k AS p_partkey, CASE WHEN count(*) OVER (PARTITION BY lower(n1)) > 1 THEN n1 || '-' || k ELSE n1 END AS unique_name FROM a""")
def collision_suffix(spark, d):
    before = F.concat_ws("-", F.lower("p_name"), (F.col("p_partkey") - 1).cast("string"))  # what a row before may become
    names = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 9 == 4, before).otherwise(F.col("p_name")).alias("name"))
    return O.suffix_collisions(names, "name", "p_partkey").select("p_partkey", "unique_name")


@query("""SELECT c_custkey, c_nationkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer) WHERE rank <= 3""")
def top_k_per_group(spark, d):
    return O.top_k(table(spark, d, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 3).select("c_custkey", "c_nationkey", "rank")


@query("""WITH s AS (SELECT event_id, event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events WHERE event_type IN ('signup', 'purchase'))
 SELECT event_id FROM s WHERE event_type = 'signup' AND (next IS NULL OR next = 'signup')""")
def unfinished_attempts(spark, d):
    e = table(spark, d, "events").where("event_type in ('signup', 'purchase')").select("event_id", "user_id", "ts", "event_type")
    return O.unfinished(e, "user_id", ["ts", "event_id"], "event_type", "signup").select("event_id")


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type = 'signup' AS is_on FROM events WHERE event_type IN ('signup', 'error')),
 r AS (SELECT *, sum(is_on::INT) OVER w AS ons, sum((NOT is_on)::INT) OVER w AS offs FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
 l AS (SELECT *, greatest(max(offs - ons) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0) AS lost FROM r),
 o AS (SELECT user_id, ts AS on_at, ons AS k FROM l WHERE is_on), f AS (SELECT user_id, ts AS off_at, offs - lost AS k, lost > coalesce(lag(lost) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS alone, is_on FROM l)
 SELECT user_id, on_at, off_at FROM o LEFT JOIN (SELECT user_id, off_at, k FROM f WHERE NOT is_on AND NOT alone) USING (user_id, k) UNION ALL SELECT user_id, NULL, off_at FROM f WHERE NOT is_on AND alone""")
def fifo_pairing(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return O.pair_fifo(e, ["user_id"], ["ts", "event_id"], "event_type", "signup", "error")


@query("""WITH RECURSIVE r AS (SELECT l_partkey % 40 AS page, round(l_extendedprice, -2) AS y FROM lineitem), d AS (SELECT page, list(DISTINCT y ORDER BY y) AS v FROM r GROUP BY page),
 t(page, k, run, hit) AS (SELECT page, 0, []::DOUBLE[], []::DOUBLE[] FROM d UNION ALL
 SELECT page, k + 1, CASE WHEN len(n) = 5 THEN [] ELSE n END, CASE WHEN len(n) = 5 THEN n ELSE [] END FROM (
 SELECT t.page, k, list_append(CASE WHEN len(run) >= 2 AND abs((v[k + 1] - run[-1]) - (run[2] - run[1])) > 1.0 THEN [run[-1]] ELSE run END, v[k + 1]) AS n FROM t JOIN d USING (page) WHERE k < len(v)))
 SELECT page, hit[1] AS run_start, hit[5] AS run_stop, (hit[5] - hit[1]) / 4 AS spacing FROM t WHERE len(hit) = 5""")
def staff_line_runs(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_partkey") % 40).alias("page"), F.round("l_extendedprice", -2).alias("y"))
    return O.spacing_runs(rows, ["page"], "y", 5, 1.0)


@query("""WITH f AS (SELECT c_custkey AS file, 1000 AS total FROM customer), d AS (SELECT o_custkey AS file, o_orderkey % 1000 AS a, o_orderkey % 1000 + 50 AS b FROM orders),
 u AS (SELECT file, unnest(range(0, 1000)) AS byte FROM f), g AS (SELECT file, byte FROM u WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.file = u.file AND byte >= a AND byte < b)),
 r AS (SELECT file, byte, byte - row_number() OVER (PARTITION BY file ORDER BY byte) AS run FROM g),
 w AS (SELECT file, byte, (byte - min(byte) OVER (PARTITION BY file, run)) // 64 AS part, run FROM r)
 SELECT file, min(byte) AS start, max(byte) + 1 AS stop FROM w GROUP BY file, run, part""")
def range_gap_plan(spark, d):
    files = table(spark, d, "customer").select(F.col("c_custkey").alias("file"), F.lit(1000).cast("long").alias("total"))
    at = (F.col("o_orderkey") % 1000).cast("long")
    done = table(spark, d, "orders").select(F.col("o_custkey").alias("file"), at.alias("start"), (at + 50).alias("stop"))
    return O.planned_ranges(files, done, "file", 64)


@query(r"""SELECT c_custkey FROM customer ORDER BY regexp_replace(lower(c_name), '0*([0-9]+)', '\1'), c_custkey LIMIT 18""")
def first_page(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.regexp_replace(F.lower("c_name"), r"0*([0-9]+)", "$1").alias("k"))
    return rows.orderBy("k", "c_custkey").limit(18).select("c_custkey")


@query("""SELECT p_partkey, row_number() OVER (ORDER BY lower(p_brand), lower(p_name), p_partkey) AS place FROM part""")
def canonical_order(spark, d):
    keys = [F.lower("p_brand"), F.lower("p_name"), F.col("p_partkey")]
    return O.dense_ids(table(spark, d, "part").select("p_partkey", "p_brand", "p_name"), keys, "n").select("p_partkey", (F.col("n") + 1).alias("place"))


@query(r"""SELECT c_custkey, regexp_replace(regexp_replace(lower(c_name), '([0-9]+)', '000000000000\1', 'g'), '0*([0-9]{12})([^0-9]|$)', '\1\2', 'g') AS sort_key FROM customer""")
def natural_sort_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", X.natural_key(F.col("c_name")).alias("sort_key"))


@query("""SELECT window_start, event_type, count(*) AS n FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type FROM events) GROUP BY ALL""")
def tumbling_window(spark, d):
    e = table(spark, d, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return e.select(F.col("window.start").alias("window_start"), "event_type", "n")


@query("""WITH n AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS new FROM events),
 i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM n)
 SELECT user_id, min(ts) AS session_start, count(*) AS n FROM i GROUP BY user_id, s""")
def session_window(spark, d):
    e = table(spark, d, "events").groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count(F.lit(1)).alias("n"))
    return e.select("user_id", F.col("session_window.start").alias("session_start"), "n")


@query()
def html_sections(spark, d):
    from ..sources import markup

    return markup.read_sections(table(spark, d, "pages"))


@query("""WITH m AS (SELECT s_suppkey::VARCHAR AS score, unnest([1, 2, 3, 2, 4, 5]) AS measure, unnest([0, 1, 2, 3, 4, 5]) AS place FROM supplier WHERE s_suppkey % 2 = 0)
 SELECT score, place, measure FROM m UNION ALL SELECT s_suppkey::VARCHAR, unnest([0, 1, 2, 3, 4]), unnest([1, 2, 3, 4, 5]) FROM supplier WHERE s_suppkey % 2 = 1""")
def played_measures(spark, d):
    from ..operators import notation as N

    even = F.col("s_suppkey") % 2 == 0
    m = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("score"), even.alias("even"), F.explode(F.expr("sequence(1L, 5L)")).alias("measure"))
    ending = F.when(F.col("even") & (F.col("measure") == 3), 1).when(F.col("even") & (F.col("measure") == 4), 2)
    rows = m.select("score", "measure", (F.col("even") & (F.col("measure") == 2)).alias("opens"), (F.col("even") & (F.col("measure") == 3)).alias("closes"), ending.alias("ending"))
    return N.play_order(rows)


@query("""WITH n AS (SELECT user_id AS id, event_id AS start, event_id + 40 AS stop, event_type <> 'error' AS tied FROM events), w AS (SELECT o_custkey AS id, o_orderkey * 0 + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, o_orderstatus AS s FROM orders),
 t AS (SELECT id, k, s, lag(s) OVER (PARTITION BY id ORDER BY k) AS p FROM w), g AS (SELECT *, sum(CASE WHEN s = 'F' AND p IS NOT NULL THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY k) AS n FROM t)
 SELECT id::VARCHAR AS id, min(k) AS start, max(k) + 1 AS stop FROM g GROUP BY id, n""")
def tied_notes(spark, d):
    """A customer's orders as notes that follow each other; finished ones are tied to the one before."""
    from pyspark.sql import Window as W

    from ..operators import notation as N

    k = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long")
    notes = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("id"), k.alias("start"), (F.col("o_orderstatus") == "F").alias("tied"))
    notes = notes.select("id", F.lit(1).alias("staff"), F.lit("1").alias("voice"), F.lit(60).alias("pitch"), "start", (F.col("start") + 1).alias("stop"), "tied")
    return N.merge_ties(notes).select("id", "start", "stop")


@query("""WITH a AS (SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k, l_linenumber AS p FROM lineitem), d AS (SELECT id, k, CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN 12 ELSE k * 12 END AS d FROM a)
 SELECT id::VARCHAR AS id, CASE WHEN min(d) <> max(d) THEN 'different' WHEN min(d) = 0 THEN 'exact' WHEN min(d) % 12 = 0 THEN 'octave' ELSE 'different' END AS view FROM d GROUP BY 1""")
def view_comparison(spark, d):
    from pyspark.sql import Window as W

    from ..operators import notation as N

    k = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    a = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), k.alias("ordinal"), F.col("l_linenumber").cast("int").alias("pitch"))
    off = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 12).otherwise(F.col("ordinal") * 12)
    b = a.withColumn("pitch", F.col("pitch") + off)
    text = lambda df: df.withColumn("id", F.col("id").cast("string"))
    return N.compare_views(text(a), text(b))


@query("""WITH e AS (SELECT event_id, user_id, event_type, event_id // 4 AS tick, event_id % 3 AS track, CASE WHEN event_type = 'signup' THEN event_id % 128 END AS program FROM events),
 s AS (SELECT *, coalesce(last_value(program IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY tick, track, event_id ROWS UNBOUNDED PRECEDING), 0) AS sounding,
 bool_or(event_type = 'signup') OVER (PARTITION BY user_id, tick) AS p, min(CASE WHEN event_type IN ('signup', 'view') THEN track END) OVER (PARTITION BY user_id, tick) AS lo,
 max(CASE WHEN event_type IN ('signup', 'view') THEN track END) OVER (PARTITION BY user_id, tick) AS hi FROM e)
 SELECT event_id, sounding AS program, p AND lo < hi AS unclear, CASE WHEN event_id % 100 = sounding THEN 'same' WHEN sounding = 0 THEN 'unset' WHEN (event_id % 100) // 8 = sounding // 8 THEN 'family' ELSE 'different' END AS why
 FROM s WHERE event_type = 'view'""")
def sounding_programs(spark, d):
    from ..operators import notation as N

    kind = F.when(F.col("event_type") == "signup", "program").when(F.col("event_type") == "view", "on").otherwise("off")
    events = table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("id"), (F.col("event_id") % 3).cast("int").alias("track"), F.col("event_id").alias("ordinal"), F.expr("event_id div 4").alias("tick"), kind.alias("kind"),
        F.lit(0).alias("channel"), F.lit(60).alias("pitch"), F.when(F.col("event_type") == "signup", F.col("event_id") % 128).alias("program"),
    )
    out = N.sounding_programs(events)
    return out.select(F.col("ordinal").alias("event_id"), "program", "unclear", N.explain_programs(F.col("ordinal") % 100, F.col("program")).alias("why"))


def _stream(spark, d):
    """The events table as a stream of files."""
    from ..streaming import attempts as A

    return A.events(spark, d, pattern="events.parquet")


@query("""SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def stream_latest_state(spark, d):
    from ..streaming import attempts as A

    return A.last_of(A.run(A.latest_state(_stream(spark, d), "user_id", "event_id", ["event_type"]), spark, "update"), ["user_id"])


@query("""SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def stream_window_counts(spark, d):
    from ..streaming import attempts as A

    return A.last_of(A.run(A.windowed_counts(_stream(spark, d)), spark, "update"), ["window_start", "event_type"])


@query("""WITH e AS (SELECT user_id AS run, event_id, CASE event_type WHEN 'signup' THEN 'started' WHEN 'click' THEN 'streaming' WHEN 'purchase' THEN 'finished' END AS phase FROM events WHERE event_type IN ('signup', 'click', 'purchase')),
 p AS (SELECT *, lag(phase) OVER (PARTITION BY run ORDER BY event_id) AS before FROM e)
 SELECT run, event_id, phase, before FROM p WHERE NOT CASE phase WHEN 'started' THEN before IS NULL OR before = 'finished' WHEN 'streaming' THEN before IS NOT NULL AND before <> 'finished' ELSE before IS NOT NULL AND before <> 'finished' END""")
def attempt_phase_faults(spark, d):
    from ..streaming import attempts as A

    phase = F.create_map(*(F.lit(x) for x in ("signup", "started", "click", "streaming", "purchase", "finished")))[F.col("event_type")]
    rows = table(spark, d, "events").select(F.col("user_id").alias("run"), "event_id", phase.alias("phase")).where("phase is not null")
    return A.phase_faults(rows, "run", "event_id", "phase")


@query("""SELECT p_name AS member, count(DISTINCT p_type) AS contents, count(*) AS deliveries FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1""")
def redelivery_conflicts(spark, d):
    from ..streaming import attempts as A

    return A.conflicts(table(spark, d, "part"), "p_name", "p_type").withColumnRenamed("p_name", "member")


@query("""WITH b AS (SELECT o_custkey AS page, (o_orderkey % 500)::DOUBLE AS a, (o_orderkey % 500 + 40)::DOUBLE AS b FROM orders),
 n AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY page ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 0.5 THEN 0 ELSE 1 END AS new FROM b),
 i AS (SELECT *, sum(new) OVER (PARTITION BY page ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM n), m AS (SELECT page, max(b) - min(a) AS n FROM i GROUP BY page, k)
 SELECT page, sum(n) / 540.0 AS share FROM m GROUP BY page""")
def staff_coverage(spark, d):
    at = (F.col("o_orderkey") % 500).cast("double")
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("page"), at.alias("a"), (at + 40).alias("b"), F.lit(540.0).alias("width"))
    return O.covered_share(rows, ["page"], "a", "b", 0.5, "width")


@query("""SELECT event_id, (sum((event_type = 'signup')::INT) OVER w)::INT AS attempt, lead(event_type) OVER w IS NULL AS latest FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def attempt_numbers(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return O.numbered_attempts(e, "user_id", ["ts", "event_id"], "event_type", "signup").select("event_id", "attempt", "latest")
