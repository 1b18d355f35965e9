"""Fetch-log statistics that stay parallel when one worker holds most of the log.

A plain window per worker would put a worker's whole log into one task. Here the log is cut
into chunks of fixed time spans, six hours by default; windows run per worker and chunk, and
what a chunk needs to know about the ones before it comes from a table with one row per
worker and chunk. The chunk follows from the time alone, so a recomputed task sees the same
chunks, nothing is written in between and making a plan starts no job. A worker's calls in a
span are bounded by the rate it may call at; a denser log takes a shorter span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Span of a chunk.
CHUNK_S = 6 * 3600

# Pressure of each outcome, in hundredths.
PRESSURE = {
    "Success": 0,
    "EmptyResponse": 50,
    "Timeout": 85,
    "HttpError": 100,
    "HttpBan": 200,
    "OtherError": 60,
}
# Size of the pressure window, target and limit, pauses, errors in a row, shortest body.
WINDOW = 30
TARGET = 8  # hundredths
GOOD_ENOUGH = 12  # hundredths
BAN_PAUSE_S = 60
ERROR_PAUSE_S = 20
ERROR_LIMIT = 5
MIN_BODY = 200
ORDER = ("ts", "event_id")


# --- outcomes ----------------------------------------------------------------------


def classify_xml_attempt(log: DataFrame) -> DataFrame:
    """Add outcome and retryable for the XML endpoint."""
    ok = F.col("status").between(200, 299)
    short = F.coalesce(F.col("body_len"), F.lit(0)) < MIN_BODY
    outcome = (
        F.when(F.col("timed_out"), "timeout")
        .when(F.col("status").isin(429, 503), "throttled")
        .when(F.col("status") >= 500, "server_error")
        .when(~ok | F.col("status").isNull(), "http_error")
        .when(short, "truncated")
        .otherwise("ok")
    )
    return log.withColumn("outcome", outcome).withColumn("retryable", F.col("outcome") != "ok")


def classify_html_attempt(log: DataFrame) -> DataFrame:
    """Add outcome and retryable for the web pages. A null status without a time-out is a
    failure of another kind."""
    ok = F.col("status").between(200, 299)
    outcome = (
        F.when(F.col("timed_out"), "Timeout")
        .when(F.col("status").isNull(), "OtherError")
        .when(F.col("status") == 429, "HttpBan")
        .when(~ok, "HttpError")
        .when(F.coalesce("title", F.lit("")) == "", "EmptyResponse")
        .otherwise("Success")
    )
    return log.withColumn("outcome", outcome).withColumn("retryable", F.col("outcome") != "Success")


def outcome_of_result(success: Column) -> Column:
    """A bare success flag as outcome."""
    return F.when(success, "Success").otherwise("OtherError")


# --- chunks ------------------------------------------------------------------------


def chunk_at(log: DataFrame, ts: Column, seconds: int) -> Column:
    """Number of the span that holds ``ts``, whatever the session's time zone."""
    if log.schema["ts"].dataType.typeName() == "timestamp_ntz":
        since = (ts - F.expr("timestamp_ntz'1970-01-01 00:00:00'")).cast("interval second")
        whole = F.floor(since.cast("decimal(18,6)"))
    else:
        whole = F.unix_seconds(ts)
    return F.floor(whole / seconds).cast("long")


def chunked(log: DataFrame, seconds: int = CHUNK_S) -> DataFrame:
    """Add ``chunk``. A log that has its chunks already is taken as it is."""
    if "chunk" in log.columns:
        return log
    return log.withColumn("chunk", chunk_at(log, F.col("ts"), seconds))


def _in_chunk(start=W.unboundedPreceding, end=0) -> W:
    return W.partitionBy("worker", "chunk").orderBy(*ORDER).rowsBetween(start, end)


def _earlier_chunks(start=W.unboundedPreceding) -> W:
    return W.partitionBy("worker").orderBy("chunk").rowsBetween(start, -1)


# --- pressure ----------------------------------------------------------------------


def _with_weight(log: DataFrame) -> DataFrame:
    weights = F.create_map(*[F.lit(x) for pair in PRESSURE.items() for x in pair])
    return log.withColumn("weight", F.try_element_at(weights, F.col("outcome")))


def rolling_pressure(log: DataFrame, seconds: int = CHUNK_S) -> DataFrame:
    """Add weight, window_size, pressure and pressure_error: the mean weight of the
    worker's last 30 attempts and its distance to the target.

    A chunk takes the last 29 weights before it from the chunks ahead of it; 29 chunk
    rows are enough, as each holds at least one attempt."""
    rows = _with_weight(chunked(log, seconds))
    back = WINDOW - 1
    place = F.row_number().over(W.partitionBy("worker", "chunk").orderBy(*ORDER))
    last = W.partitionBy("worker", "chunk").orderBy(*[F.col(c).desc() for c in ORDER])
    tails = (
        rows.withColumn("from_end", F.row_number().over(last))
        .where(F.col("from_end") <= back)
        .groupBy("worker", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("from_end")).alias("at"), "weight"))).alias("tail"))
    )
    weights = F.transform("tail", lambda t: t["weight"])
    carried = tails.select(
        "worker",
        "chunk",
        F.flatten(F.collect_list(weights).over(_earlier_chunks(-back))).alias("carry"),
    )
    local = rows.select(
        "*",
        place.alias("place"),
        F.sum("weight").over(_in_chunk(-back)).alias("local_sum"),
    )
    missing = F.greatest(F.lit(WINDOW) - F.col("place"), F.lit(0))
    used = F.slice(
        "carry",
        F.greatest(F.size("carry") - missing + 1, F.lit(1)),
        F.least(missing, F.size("carry")),
    )
    both = local.join(carried, ["worker", "chunk"]).withColumn(
        "used", F.when(missing > 0, used).otherwise(F.array().cast("array<int>"))
    )
    total = F.col("local_sum") + F.aggregate(
        "used", F.lit(0).cast("bigint"), lambda a, w: a + w.cast("bigint")
    )
    size = F.least(F.col("place"), F.lit(WINDOW)) + F.size("used")
    return (
        both.withColumn("window_size", size)
        .withColumn("pressure", total / (size * 100))
        .withColumn("pressure_error", (total - size * TARGET) / (size * 100))
        .withColumn("calm", total < size * GOOD_ENOUGH)
        .drop("place", "local_sum", "carry", "used", "chunk")
    )


def best_sustained_delay(log: DataFrame, seconds: int = CHUNK_S) -> DataFrame:
    """(worker, best_delay): lowest delay with a full window under low pressure, else 0."""
    rows = rolling_pressure(log, seconds)
    good = (F.col("window_size") >= WINDOW) & F.col("calm")
    lowest = F.min(F.when(good, F.col("delay_ms")))
    return rows.groupBy("worker").agg(F.coalesce(lowest, F.lit(0)).alias("best_delay"))


# --- streaks and pauses ------------------------------------------------------------


def _streak_rows(log: DataFrame, seconds: int) -> DataFrame:
    """Add streak and own_pause, and pause_in: the pause the chunk begins with.

    A chunk is summed up by its leading failures, its trailing ones and its latest
    pauses. From those the streak and the pause at the start of every chunk follow, so
    the rows themselves are read just twice."""
    window = "(partition by worker, chunk order by ts, event_id rows unbounded preceding)"
    rows = chunked(log, seconds).selectExpr("*", "outcome <> 'Success' as failed")
    rows = rows.selectExpr(
        "*",
        f"sum(if(failed, 1, 0)) over {window} as failures",
        f"sum(if(failed, 0, 1)) over {window} as wins",
    )
    rows = rows.selectExpr(
        "* except (failures)",
        f"failures - coalesce(max(if(failed, null, failures)) over {window}, 0) as in_chunk",
        "wins = 0 as leading",
    )
    chunk_rows = rows.groupBy("worker", "chunk").agg(
        F.max("wins").alias("wins"),
        F.max_by("in_chunk", F.struct(*ORDER)).alias("tail"),
        F.count_if("leading").alias("lead_length"),
        F.max(F.when(F.col("leading"), F.col("ts"))).alias("lead_ts"),
        F.max(F.when(F.col("outcome") == "HttpBan", F.col("ts"))).alias("ban_ts"),
        F.max(
            F.when(~F.col("leading") & (F.col("in_chunk") >= ERROR_LIMIT), F.col("ts"))
        ).alias("error_ts"),
    )
    by_chunk = "(partition by worker order by chunk rows {0})"
    to_here, before = by_chunk.format("unbounded preceding"), by_chunk.format(
        "between unbounded preceding and 1 preceding"
    )
    starts = chunk_rows.selectExpr("*", f"sum(tail) over {to_here} as tails")
    # Tails add up until a chunk with a success starts them anew.
    starts = starts.selectExpr(
        "*",
        f"coalesce(max(tails) over {before}, 0) "
        f"- coalesce(max(if(wins > 0, tails - tail, null)) over {before}, 0) as streak_in",
    )
    pause = "make_dt_interval(0, 0, 0, {0})".format
    starts = starts.selectExpr(
        "worker",
        "chunk",
        "streak_in",
        f"greatest(ban_ts + {pause(BAN_PAUSE_S)}, error_ts + {pause(ERROR_PAUSE_S)}, "
        f"if(lead_length > 0 and lead_length + streak_in >= {ERROR_LIMIT}, "
        f"lead_ts + {pause(ERROR_PAUSE_S)}, null)) as pause",
    )
    starts = starts.selectExpr(
        "worker", "chunk", "streak_in", f"max(pause) over {before} as pause_in"
    )
    both = rows.join(starts, ["worker", "chunk"]).selectExpr(
        "* except (failed, wins, in_chunk, leading, streak_in)",
        "in_chunk + if(leading, streak_in, 0) as streak",
    )
    return both.selectExpr(
        "*",
        f"case when outcome = 'HttpBan' then ts + {pause(BAN_PAUSE_S)} "
        f"when streak >= {ERROR_LIMIT} then ts + {pause(ERROR_PAUSE_S)} end as own_pause",
    )


def error_streaks(log: DataFrame, seconds: int = CHUNK_S) -> DataFrame:
    """Add streak: failures in a row up to and including the attempt."""
    return _streak_rows(log, seconds).drop("chunk", "own_pause", "pause_in")


def pause_windows(log: DataFrame, seconds: int = CHUNK_S) -> DataFrame:
    """Add streak and pause_until: the running end of the worker's pause, never moved
    back."""
    rows = _streak_rows(log, seconds)
    until = F.greatest(F.max("own_pause").over(_in_chunk()), F.col("pause_in"))
    return rows.withColumn("pause_until", until).drop("chunk", "own_pause", "pause_in")


def paused_attempts(log: DataFrame, seconds: int = CHUNK_S) -> DataFrame:
    """Add streak and is_paused: the attempt came before a pause set by earlier attempts
    was over."""
    rows = _streak_rows(log, seconds)
    until = F.greatest(F.max("own_pause").over(_in_chunk(end=-1)), F.col("pause_in"))
    paused = F.coalesce(F.col("ts") < until, F.lit(False))
    return rows.withColumn("is_paused", paused).drop("chunk", "own_pause", "pause_in")


def worker_status(log: DataFrame, now: Column | None = None, seconds: int = CHUNK_S) -> DataFrame:
    """(worker, delay, best_delay, pressure, paused) as of ``now``, by default the time of
    the worker's last attempt."""
    rows = chunked(log, seconds)
    latest = F.struct(*ORDER)
    good = (F.col("window_size") >= WINDOW) & F.col("calm")
    status = rolling_pressure(rows).groupBy("worker").agg(
        F.max_by("delay_ms", latest).alias("delay"),
        F.coalesce(F.min(F.when(good, F.col("delay_ms"))), F.lit(0)).alias("best_delay"),
        F.max_by("pressure", latest).alias("pressure"),
        F.max("ts").alias("last_ts"),
    )
    ends = _streak_rows(rows, seconds).groupBy("worker").agg(F.max("own_pause").alias("pause_until"))
    now = F.col("last_ts") if now is None else now
    return status.join(ends, "worker").select(
        "worker",
        "delay",
        "best_delay",
        "pressure",
        F.coalesce(now < F.col("pause_until"), F.lit(False)).alias("paused"),
    )


# --- per id ------------------------------------------------------------------------


def fetch_resolution(
    log: DataFrame, max_attempts: int = 5, max_empty: int | None = None
) -> DataFrame:
    """(pmc_id, attempts, retries, final_outcome): the attempts up to the first success,
    the ``max_empty``-th empty response (web pages) or ``max_attempts``.

    ``attempt`` numbers the tries of an id. Later tries are cut first, so that an id
    never has more than ``max_attempts`` rows, however often it is in the log."""
    good = F.col("outcome").isin("ok", "Success")
    tries = log.where(F.col("attempt") <= max_attempts).select("pmc_id", "attempt", "outcome")
    listed = tries.groupBy("pmc_id").agg(
        F.sort_array(F.collect_list(F.struct("attempt", "outcome"))).alias("tries"),
        F.min(F.when(good, F.col("attempt"))).alias("won_at"),
        F.max("attempt").alias("last_at"),
    )
    empties = F.filter("tries", lambda t: t["outcome"] == "EmptyResponse")
    gave_up = F.get(empties, F.lit(max_empty - 1))["attempt"] if max_empty else F.lit(None)
    end = F.least("won_at", gave_up.cast("int"), "last_at")
    final = F.filter("tries", lambda t: t["attempt"] == F.col("end"))[0]["outcome"]
    return listed.withColumn("end", end).select(
        "pmc_id",
        F.col("end").alias("attempts"),
        (F.col("end") - 1).alias("retries"),
        final.alias("final_outcome"),
    )


# --- rates -------------------------------------------------------------------------


#: What a row of the audit is: a dispatch, the time one second before it, or a dispatch of the
#: chunk before that the first second of this one still counts.
CALL, PROBE, EARLIER = 0, 1, 2


def rate_gap_audit(
    log: DataFrame, min_gap_ms: int = 110, cap: int = 3, seconds: int = CHUNK_S
) -> DataFrame:
    """(worker, event_id, ts, gap_ms, last_second, violation): the gap to the worker's
    previous dispatch, and its dispatches in the second up to this one.

    The count is a difference of two running counts: at the dispatch, and one second
    before it. The latter are probe rows in the same chunk, so that a busy second is never
    gathered in one place. A dispatch in the last second of a chunk goes to the next one
    as well. The log is exchanged once; beside it goes a row per worker and chunk. Every row of the
    log is a dispatch and gives a row; repeated ones follow each other at a gap of 0."""
    log = log.withColumn("row", F.monotonically_increasing_id())
    ts = F.col("ts")
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1))
    here, after = chunk_at(log, ts, seconds), chunk_at(log, ts + second, seconds)

    def entry(kind: int, at: Column, chunk: Column) -> Column:
        return F.struct(chunk.alias("chunk"), at.alias("at"), F.lit(kind).alias("kind"))

    own = F.array(entry(CALL, ts, here), entry(PROBE, ts - second, here))
    both = F.concat(own, F.array(entry(EARLIER, ts, after)))
    rows = (
        log.select("worker", "row", "event_id", "ts", F.explode(F.when(here == after, own).otherwise(both)).alias("e"))
        .select("worker", "row", "event_id", "ts", "e.*")
        .withColumn("is_call", F.when(F.col("kind") == PROBE, 0).otherwise(1))
    )
    # A probe sorts after the calls of its own instant, and so does not count them in.
    w = W.partitionBy("worker", "chunk").orderBy("at", F.col("is_call").desc(), "event_id", "row")
    call_at = F.when(F.col("is_call") == 1, F.col("at"))
    counted = rows.select(
        "*",
        F.sum("is_call").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("count"),
        F.max(call_at).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("before"),
    ).where(F.col("kind") != EARLIER)
    is_call = F.col("kind") == CALL
    # A dispatch and its probe come out of one row, so the row's number pairs them.
    paired = counted.groupBy("worker", "chunk", "row").agg(
        F.max("event_id").alias("event_id"),
        F.max("ts").alias("ts"),
        F.sum(F.when(is_call, F.col("count")).otherwise(-F.col("count"))).alias("last_second"),
        F.max(F.when(is_call, F.col("before"))).alias("in_chunk"),
    )
    last = log.groupBy("worker", here.alias("chunk")).agg(F.max("ts").alias("last_call"))
    carried = last.select("worker", "chunk", F.max("last_call").over(_earlier_chunks()).alias("carry"))
    micros = F.expr("timestampdiff(MICROSECOND, previous, ts)")
    return (
        paired.join(carried, ["worker", "chunk"])
        .withColumn("previous", F.coalesce("in_chunk", "carry"))
        .select(
            "worker",
            "event_id",
            "ts",
            F.floor(micros / 1000).alias("gap_ms"),
            "last_second",
            (F.coalesce(micros < min_gap_ms * 1000, F.lit(False)) | (F.col("last_second") > cap)).alias("violation"),
        )
    )
