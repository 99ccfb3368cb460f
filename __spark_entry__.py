
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sequon.functions.alerts import paid_text, run_text, timeout_text  # noqa: E402
from sequon.functions.rows import (  # noqa: E402
    LOGIN_FORM,
    ORDER_FORM,
    SENSOR_FORM,
    distinct_rows,
    render,
    same_row,
    with_defaults,
)
from sequon.functions.times import event_time, utc_time  # noqa: E402
from sequon.model import split_null_keys  # noqa: E402
from sequon.operators.machine import (  # noqa: E402
    Machine,
    Rule,
    machine_alerts,
    run_alert_machine,
    run_machine,
)
from sequon.operators.runs import run_alerts, run_lengths  # noqa: E402
from sequon.operators.sequence import Pattern, Step, as_map, by_status, match, step_row  # noqa: E402
from sequon.operators.words import word_count  # noqa: E402
from sequon.plans.segments import plan_segments  # noqa: E402
from sequon.sources.ending import mark_end, replay, run_to_end, with_end  # noqa: E402
from sequon.sources.lines import parse_lines, parse_or_quarantine  # noqa: E402
from sequon.sources.sinks import labelled, read_output, write_outputs  # noqa: E402
from sequon.sources.tables import arriving, table  # noqa: E402
from sequon.streaming.folders import new_folder  # noqa: E402
from sequon.streaming.machine import machine_stream  # noqa: E402
from sequon.streaming.routes import plan_routes  # noqa: E402
from sequon.streaming.sequence import match_stream  # noqa: E402

USER, ORDER = ["user_id"], ["ts", "event_id"]
BOUND = timedelta(hours=24)
#: How long a machine's state lasts in the queries with expiry.
EXPIRE = timedelta(hours=12)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    # Times in the tables carry no zone and are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, folder, "events")


def _hot(events: DataFrame) -> DataFrame:
    """The same events with a third of them under one key."""
    user = F.when(F.col("user_id") % 3 == 0, -1).otherwise(F.col("user_id"))
    return events.withColumn("user_id", user)


def _hot_events(spark: SparkSession, folder: str) -> DataFrame:
    return _hot(_events(spark, folder))


#: Rows per segment of the hot-key queries: few, so that the key is cut in small tables too.
HOT_SEGMENT_ROWS = 1_000


def _us(ts: str | Column) -> Column:
    return F.unix_micros(utc_time(ts))


def _ms(ts: str) -> Column:
    return F.unix_millis(utc_time(ts))


def _whole(value: str) -> Column:
    return F.floor(value).cast("int")


def _type(name: str) -> Column:
    return F.col("event_type") == name


def _purchase() -> Pattern:
    """Sign up, then buy within a day."""
    return Pattern(Step("create", _type("signup")), Step("pay", _type("purchase")), BOUND)


def _matches(events: DataFrame, **options) -> DataFrame:
    keep = ["event_id", "user_id", "ts"]
    return match(events, _purchase(), USER, "ts", "event_id", keep, **options)


def _outcome(matches: DataFrame) -> DataFrame:
    return matches.select(
        F.col("create.event_id").alias("event_id"),
        "user_id",
        _us(F.col("create.ts")).alias("first_us"),
        F.col("pay.event_id").alias("second_id"),
        _us(F.col("pay.ts")).alias("second_us"),
        "status",
    )


def _pattern(spark: SparkSession, folder: str) -> DataFrame:
    return _outcome(_matches(_events(spark, folder)))


def _pattern_pending(spark: SparkSession, folder: str) -> DataFrame:
    return _outcome(_matches(_events(spark, folder), as_of=datetime(2024, 1, 15)))


def _pattern_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    events = _hot_events(spark, folder)
    return _outcome(_matches(events, segment_rows=HOT_SEGMENT_ROWS))


def _pattern_paid(spark: SparkSession, folder: str) -> DataFrame:
    paid = by_status(_matches(_events(spark, folder)), "payed")
    return paid.select(
        F.col("pay.event_id").alias("pay_id"), paid_text(F.col("pay.user_id")).alias("text")
    )


def _pattern_timeout(spark: SparkSession, folder: str) -> DataFrame:
    late = by_status(_matches(_events(spark, folder)), "timeout")
    create = F.col("create")
    return late.select(
        create["event_id"].alias("create_id"),
        timeout_text(create["event_id"], create["user_id"]).alias("text"),
    )


def _pattern_map(spark: SparkSession, folder: str) -> DataFrame:
    found = as_map(_matches(_events(spark, folder)), _purchase())
    steps = F.col("match")
    return found.select(
        step_row(steps, "create")["event_id"].alias("create_id"),
        step_row(steps, "pay")["event_id"].alias("pay_id"),
        F.size(steps).alias("steps"),
    )


def _alert_text(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    runs = run_alerts(events, USER, ORDER, _type("error"))
    matches = _matches(events)
    paid, late = by_status(matches, "payed"), by_status(matches, "timeout")
    create, pay = F.col("create"), F.col("pay")
    outputs = [
        ("warning", runs.select("event_id", run_text("user_id").alias("text"))),
        ("payed", paid.select("pay.event_id", paid_text(pay["event_id"]).alias("text"))),
        (
            "timeout",
            late.select(
                "create.event_id",
                # Some users are left out here, to show how a missing one prints.
                timeout_text(create["event_id"], F.expr("nullif(create.user_id % 5, 0)")).alias(
                    "text"
                ),
            ),
        ),
    ]
    texts = [labelled(df, label) for label, df in outputs]
    return texts[0].unionByName(texts[1]).unionByName(texts[2])


def _type_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).where(_type("purchase")).select("event_id", "user_id")


def _null_keys(spark: SparkSession, folder: str) -> DataFrame:
    keyed = _events(spark, folder).withColumn("user_id", F.expr("nullif(user_id % 10, 0)"))
    taken, refused = split_null_keys(keyed, USER)
    both = [labelled(df.select("event_id"), name) for df, name in ((taken, "taken"), (refused, "refused"))]
    return both[0].unionByName(both[1])


def _run_alert(spark: SparkSession, folder: str) -> DataFrame:
    alerts = run_alerts(_events(spark, folder), USER, ORDER, _type("error"))
    return alerts.select("event_id", "user_id", _us("ts").alias("at_us"))


def _run_alert_n(spark: SparkSession, folder: str) -> DataFrame:
    alerts = run_alerts(_events(spark, folder), USER, ORDER, _type("error"), n=2)
    return alerts.select("event_id", "user_id")


def _run_lengths(spark: SparkSession, folder: str) -> DataFrame:
    kind = _type("error") | _type("view")
    return run_lengths(_events(spark, folder), USER, ORDER, kind).select("event_id", "run_length")


def _run_alert_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    events = _hot_events(spark, folder)
    alerts = run_alerts(events, USER, ORDER, _type("error"), segment_rows=HOT_SEGMENT_ROWS)
    return alerts.select("event_id", "user_id")


def _parse_lines(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    sign = F.when(_type("click"), "+").otherwise("")
    lines = events.select(
        F.concat_ws(",", "event_type", F.concat(sign, "event_id"), _whole("value"), "props").alias("value")
    )
    return parse_lines(lines)


def _broken_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of which only those of sign-ups and purchases are good."""
    lead = F.concat_ws(",", "event_type", "event_id")
    line = (
        F.when(_type("error"), F.concat_ws(", ", "event_type", "event_id", _whole("value")))
        .when(_type("view"), lead)
        .when(_type("click"), F.concat(lead, F.lit(",2147483648")))
        .when(_type("signup"), F.concat(lead, F.lit(",+"), _whole("value")))
        .otherwise(F.concat_ws(",", lead, _whole("value"), F.lit("x"), F.lit("")))
    )
    return _events(spark, folder).select(line.alias("value"))


def _parse_good(spark: SparkSession, folder: str) -> DataFrame:
    return parse_or_quarantine(_broken_lines(spark, folder))[0]


def _parse_bad(spark: SparkSession, folder: str) -> DataFrame:
    return parse_or_quarantine(_broken_lines(spark, folder))[1]


def _render_rows(spark: SparkSession, folder: str) -> DataFrame:
    no_ip = F.when(_type("click"), None).otherwise(F.col("props"))
    return _events(spark, folder).select(
        "event_id",
        render(LOGIN_FORM, "user_id", no_ip, "event_type", _ms("ts"), _whole("value")).alias("login"),
        render(SENSOR_FORM, "event_type", _ms("ts"), _whole("value")).alias("sensor"),
        render(ORDER_FORM, "user_id", "event_id", "event_type", _ms("ts")).alias("order"),
    )


def _sensor_rows(events: DataFrame) -> DataFrame:
    """Sensor-like rows with nulls and many copies."""
    day_ms = _ms(F.date_trunc("day", "ts"))
    return events.select(
        "event_id",
        F.when(~_type("error"), F.col("event_type")).alias("id"),
        day_ms.alias("ts"),
        F.when(F.col("value") < 50, (_whole("value") / 10).cast("int")).alias("vc"),
    )


def _dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_rows(_sensor_rows(_events(spark, folder)), ["id", "ts", "vc"])


def _equal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Is each event, as a sensor row, equal to the event before it?"""
    rows = _sensor_rows(_events(spark, folder)).alias("now")
    earlier = _sensor_rows(_events(spark, folder)).withColumn("event_id", F.col("event_id") + 1)
    pairs = rows.join(earlier, rows["event_id"] == earlier["event_id"])
    return pairs.select(
        rows["event_id"], same_row(rows, earlier, ["id", "ts", "vc"]).cast("int").alias("same")
    )


def _default_amount(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.when(_type("purchase"), _whole("value"))
    logins = _events(spark, folder).select("event_id", amount.alias("amount"))
    return with_defaults(logins, {"amount": 0})


def _event_time(spark: SparkSession, folder: str) -> DataFrame:
    at = event_time(_ms("ts"))
    return _events(spark, folder).select(
        "event_id",
        F.unix_micros(at).alias("at_us"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSS").alias("at_text"),
    )


def _funnel() -> Machine:
    """Look, choose, then join or buy; every purchase from there is reported."""
    return Machine(
        "Idle",
        (
            Rule("Idle", "view", "Looking"),
            Rule("Looking", "view", "Looking"),
            Rule("Looking", "click", "Chosen"),
            Rule("Looking", "click", "Idle"),  # never applies: the rule above comes first
            Rule("Looking", "error", "Terminal"),
            Rule("Chosen", "click", "Chosen"),
            Rule("Chosen", "signup", "Joined"),
            Rule("Chosen", "purchase", "Matched"),
            Rule("Joined", "view", "Joined"),
            Rule("Joined", "purchase", "Matched"),
            Rule("Joined", "error", "Terminal"),
        ),
    )


def _states(events: DataFrame, machine: Machine, **options) -> DataFrame:
    traced = run_machine(
        events, machine, USER, ORDER, F.col("event_type"), keep=["event_id"], **options
    )
    return traced.select("event_id", "user_id", "state", F.col("matched").cast("int").alias("matched"))


def _fsm_states(spark: SparkSession, folder: str) -> DataFrame:
    return _states(_events(spark, folder), run_alert_machine("error", "view"))


def _fsm_alerts(spark: SparkSession, folder: str) -> DataFrame:
    alerts = machine_alerts(
        _events(spark, folder),
        run_alert_machine("error", "view"),
        USER,
        ORDER,
        F.col("event_type"),
        keep=["event_id"],
    )
    return alerts.select("event_id", run_text("user_id").alias("text"))


def _fsm_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return _states(_events(spark, folder), _funnel())


def _fsm_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    events = _hot_events(spark, folder)
    return _states(events, _funnel(), segment_rows=HOT_SEGMENT_ROWS)


def _fsm_expiry(spark: SparkSession, folder: str) -> DataFrame:
    return _states(_events(spark, folder), run_alert_machine("error", "view"), expire=EXPIRE)


def _fsm_expiry_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    machine, rows = run_alert_machine("error", "view"), HOT_SEGMENT_ROWS
    return _states(_hot_events(spark, folder), machine, segment_rows=rows, expire=EXPIRE)


def _word_count(spark: SparkSession, folder: str) -> DataFrame:
    return word_count(table(spark, folder, "documents"), "text")


#: Micro-batches a table is replayed in.
STREAM_SLICES = 10


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as they would have arrived, slice by slice."""
    events = _events(spark, folder).select("event_id", "ts", "user_id", "event_type")
    slices = f"{new_folder(spark)}/events"
    replay(events, slices, "ts", STREAM_SLICES)
    return arriving(spark, slices, events.schema, 1).withColumn("ts", utc_time("ts"))


def _matched_to_end(spark: SparkSession, stream: DataFrame, progress: str | None = None, **options) -> str:
    """Folder of the matches of a stream that has come to its end."""
    keep = ["event_id", "user_id", "ts"]
    folder = new_folder(spark)
    marks, progress = f"{folder}/marks", progress or f"{folder}/progress"
    ended = with_end(stream, marks)
    found = match_stream(ended, _purchase(), USER, "ts", "event_id", keep, **options)
    run_to_end(
        lambda: write_outputs(found, f"{folder}/out", progress),
        lambda: mark_end(spark, marks, stream.schema, "ts"),
    )
    return f"{folder}/out"


def _stream_pattern(spark: SparkSession, folder: str) -> DataFrame:
    out = _matched_to_end(spark, _event_stream(spark, folder))
    return _outcome(spark.read.parquet(out))


def _stream_pattern_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    progress = f"{new_folder(spark)}/progress"
    segments = plan_segments(_hot_events(spark, folder), USER, ORDER, HOT_SEGMENT_ROWS)
    routes = plan_routes(spark, progress, USER, segments)
    out = _matched_to_end(spark, _hot(_event_stream(spark, folder)), progress, routes=routes)
    return _outcome(spark.read.parquet(out))


def _stream_pattern_ascending(spark: SparkSession, folder: str) -> DataFrame:
    out = _matched_to_end(spark, _hot(_event_stream(spark, folder)), buffered=False)
    return _outcome(spark.read.parquet(out))


def _stream_timeout(spark: SparkSession, folder: str) -> DataFrame:
    out = _matched_to_end(spark, _event_stream(spark, folder))
    create = F.col("create")
    return read_output(spark, out, "timeout").select(
        create["event_id"].alias("create_id"),
        timeout_text(create["event_id"], create["user_id"]).alias("text"),
    )


def _run_outputs(spark: SparkSession, rows: DataFrame, by: str) -> str:
    folder = new_folder(spark)
    write_outputs(rows, f"{folder}/out", f"{folder}/progress", by).awaitTermination()
    return f"{folder}/out"


def _stream_alerts(spark: SparkSession, stream: DataFrame, **options) -> DataFrame:
    machine = run_alert_machine("error", "view")
    alerts = machine_stream(
        stream, machine, USER, ORDER, F.col("event_type"), keep=["event_id"], **options
    )
    texts = labelled(alerts.select("event_id", run_text("user_id").alias("text")), "warning")
    return read_output(spark, _run_outputs(spark, texts, "label"), "warning", "label")


def _stream_run_alert(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_alerts(spark, _event_stream(spark, folder))


def _stream_run_alert_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_alerts(spark, _hot(_event_stream(spark, folder)))


def _stream_run_alert_expiry(spark: SparkSession, folder: str) -> DataFrame:
    return _stream_alerts(spark, _event_stream(spark, folder), expire=EXPIRE)


def entry(spark: SparkSession) -> DataFrame:
    """Sign-ups and what became of them, on the smallest tables."""
    return _pattern(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pattern_match": _pattern,
        "pattern_pending": _pattern_pending,
        "pattern_hot_key": _pattern_hot_key,
        "pattern_paid": _pattern_paid,
        "pattern_timeout": _pattern_timeout,
        "pattern_map": _pattern_map,
        "alert_text": _alert_text,
        "type_filter": _type_filter,
        "null_keys": _null_keys,
        "run_alert": _run_alert,
        "run_alert_n": _run_alert_n,
        "run_lengths": _run_lengths,
        "run_alert_hot_key": _run_alert_hot_key,
        "parse_lines": _parse_lines,
        "parse_good": _parse_good,
        "parse_bad": _parse_bad,
        "render_rows": _render_rows,
        "dedupe_rows": _dedupe_rows,
        "equal_rows": _equal_rows,
        "default_amount": _default_amount,
        "event_time": _event_time,
        "fsm_states": _fsm_states,
        "fsm_alerts": _fsm_alerts,
        "fsm_funnel": _fsm_funnel,
        "fsm_hot_key": _fsm_hot_key,
        "fsm_expiry": _fsm_expiry,
        "fsm_expiry_hot_key": _fsm_expiry_hot_key,
        "word_count": _word_count,
        "stream_pattern": _stream_pattern,
        "stream_pattern_hot_key": _stream_pattern_hot_key,
        "stream_pattern_ascending": _stream_pattern_ascending,
        "stream_timeout": _stream_timeout,
        "stream_run_alert": _stream_run_alert,
        "stream_run_alert_hot_key": _stream_run_alert_hot_key,
        "stream_run_alert_expiry": _stream_run_alert_expiry,
    }


_HOT = "(SELECT * REPLACE (CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS user_id) FROM events)"


def _pattern_sql(events: str = "events") -> str:
    """The next purchase after each sign-up, in time or not."""
    return f"""
SELECT e.event_id, e.user_id, epoch_us(e.ts) AS first_us,
       CASE WHEN n.ts < e.ts + INTERVAL 24 HOUR THEN n.event_id END AS second_id,
       CASE WHEN n.ts < e.ts + INTERVAL 24 HOUR THEN epoch_us(n.ts) END AS second_us,
       CASE WHEN n.ts < e.ts + INTERVAL 24 HOUR THEN 'payed' ELSE 'timeout' END AS status
FROM {events} e LEFT JOIN LATERAL (
  SELECT p.ts, p.event_id FROM {events} p
  WHERE p.user_id = e.user_id AND p.event_type = 'purchase'
    AND (p.ts, p.event_id) > (e.ts, e.event_id)
  ORDER BY p.ts, p.event_id LIMIT 1) n ON TRUE
WHERE e.event_type = 'signup'"""


def _runs_sql(hit: str, events: str = "events") -> str:
    """Hits since the last break, by row numbers."""
    return f"""
SELECT event_id, user_id, ts,
       rn - coalesce(max(CASE WHEN NOT hit THEN rn END) OVER (
         PARTITION BY user_id ORDER BY ts, event_id), 0) AS run_length
FROM (SELECT event_id, user_id, ts, {hit} AS hit,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM {events})"""


def _funnel_sql(events: str = "events") -> str:
    """The funnel, one event of every user at a time."""
    return f"""
WITH RECURSIVE seq AS (
  SELECT event_id, user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM {events}),
walk AS (
  SELECT user_id, 0::BIGINT AS rn, NULL::BIGINT AS event_id, 'Idle' AS state, 0 AS matched
  FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.user_id, s.rn, s.event_id,
         CASE WHEN w.state = 'Idle' AND s.event_type = 'view' THEN 'Looking'
              WHEN w.state = 'Looking' AND s.event_type = 'view' THEN 'Looking'
              WHEN w.state = 'Looking' AND s.event_type = 'click' THEN 'Chosen'
              WHEN w.state = 'Chosen' AND s.event_type IN ('click', 'purchase') THEN 'Chosen'
              WHEN w.state = 'Chosen' AND s.event_type = 'signup' THEN 'Joined'
              WHEN w.state = 'Joined' AND s.event_type IN ('view', 'purchase') THEN 'Joined'
              ELSE 'Idle' END,
         CASE WHEN w.state IN ('Chosen', 'Joined') AND s.event_type = 'purchase' THEN 1 ELSE 0 END
  FROM walk w JOIN seq s ON s.user_id = w.user_id AND s.rn = w.rn + 1)
SELECT event_id, user_id, state, matched FROM walk WHERE rn > 0"""


def _sessions_sql(events: str = "events") -> str:
    """Length of the run of errors each event ends, in which no event comes twelve hours or
    more after the one before it."""
    return f"""
SELECT event_id, user_id,
       CASE WHEN event_type = 'error' THEN count(*) OVER (
         PARTITION BY user_id, session, broken ORDER BY ts, event_id)
         - CASE WHEN broken > 0 THEN 1 ELSE 0 END ELSE 0 END AS run_length
FROM (SELECT *, count(*) FILTER (event_type <> 'error') OVER (
        PARTITION BY user_id, session ORDER BY ts, event_id) AS broken
      FROM (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
            FROM (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (
                    PARTITION BY user_id ORDER BY ts, event_id) >= 43200000000 THEN 1 ELSE 0 END AS starts
                  FROM {events})))"""


def _run_states_sql(runs: str) -> str:
    return f"""
SELECT event_id, user_id,
       CASE least(run_length, 2) WHEN 0 THEN 'Initial' WHEN 1 THEN 'S1' ELSE 'S2' END AS state,
       CASE WHEN run_length >= 3 THEN 1 ELSE 0 END AS matched
FROM ({runs})"""


_RUN_STATES = _run_states_sql(_runs_sql("event_type = 'error'"))


def _text_sql(runs: str) -> str:
    return f"""
SELECT event_id, user_id || ' 连续三次登录失败' AS text FROM ({runs}) WHERE run_length >= 3"""


def _run_text_sql(events: str = "events") -> str:
    return _text_sql(_runs_sql("event_type = 'error'", events))


_SENSOR_SQL = """
SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS id,
       epoch_ms(date_trunc('day', ts)) AS ts,
       CASE WHEN value < 50 THEN trunc(floor(value) / 10)::INT END AS vc
FROM events"""

_BROKEN_SQL = """
SELECT CASE event_type
         WHEN 'error' THEN event_type || ', ' || event_id || ', ' || floor(value)::INT
         WHEN 'view' THEN event_type || ',' || event_id
         ELSE event_type || ',' || event_id || ',2147483648' END AS value
FROM events WHERE event_type IN ('error', 'view', 'click')"""

def oracle_sql() -> dict[str, str]:
    timeout_text_sql = "'订单 ' || event_id || ' 超时未支付！用户为：' || user_id"
    return {
        "pattern_match": _pattern_sql(),
        "pattern_pending": f"""
WITH seen AS (SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00')
SELECT * REPLACE (CASE WHEN status = 'timeout'
                        AND first_us + 86400000000 > epoch_us(TIMESTAMP '2024-01-15 00:00:00')
                       THEN 'pending' ELSE status END AS status)
FROM ({_pattern_sql("seen")})""",
        "pattern_hot_key": _pattern_sql(_HOT),
        "pattern_paid": f"""
SELECT second_id AS pay_id, '订单 ' || user_id || ' 已支付！' AS text
FROM ({_pattern_sql()}) WHERE status = 'payed'""",
        "pattern_timeout": f"""
SELECT event_id AS create_id, {timeout_text_sql} AS text
FROM ({_pattern_sql()}) WHERE status = 'timeout'""",
        "pattern_map": f"""
SELECT event_id AS create_id, second_id AS pay_id,
       CASE WHEN second_id IS NULL THEN 1 ELSE 2 END AS steps
FROM ({_pattern_sql()})""",
        "alert_text": f"""
SELECT 'warning' AS label, event_id, text FROM ({_run_text_sql()})
UNION ALL
SELECT 'payed', second_id, '订单 ' || second_id || ' 已支付！'
FROM ({_pattern_sql()}) WHERE status = 'payed'
UNION ALL
SELECT 'timeout', event_id, '订单 ' || event_id || ' 超时未支付！用户为：'
       || coalesce(nullif(user_id % 5, 0)::VARCHAR, 'null')
FROM ({_pattern_sql()}) WHERE status = 'timeout'""",
        "type_filter": "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'",
        "null_keys": """
SELECT CASE WHEN user_id % 10 = 0 THEN 'refused' ELSE 'taken' END AS label, event_id FROM events""",
        "run_alert": f"""
SELECT event_id, user_id, epoch_us(ts) AS at_us
FROM ({_runs_sql("event_type = 'error'")}) WHERE run_length >= 3""",
        "run_alert_n": f"""
SELECT event_id, user_id FROM ({_runs_sql("event_type = 'error'")}) WHERE run_length >= 2""",
        "run_lengths": f"""
SELECT event_id, run_length FROM ({_runs_sql("event_type IN ('error', 'view')")})""",
        "run_alert_hot_key": f"""
SELECT event_id, user_id FROM ({_runs_sql("event_type = 'error'", _HOT)}) WHERE run_length >= 3""",
        "parse_lines": "SELECT event_type AS id, event_id AS ts, floor(value)::INT AS vc FROM events",
        "parse_good": """
SELECT event_type AS id, event_id AS ts, floor(value)::INT AS vc
FROM events WHERE event_type IN ('signup', 'purchase')""",
        "parse_bad": _BROKEN_SQL,
        "render_rows": """
SELECT event_id,
       'LoginEvent{userId=''' || user_id || ''', ipAddress='''
         || CASE WHEN event_type = 'click' THEN 'null' ELSE props END
         || ''', eventType=''' || event_type || ''', timestamp=' || (epoch_us(ts) // 1000)
         || ', amount=' || floor(value)::INT || '}' AS login,
       'WaterSensor{id=''' || event_type || ''', ts=' || (epoch_us(ts) // 1000)
         || ', vc=' || floor(value)::INT || '}' AS sensor,
       'OrderEvent{userId=''' || user_id || '''orderId=''' || event_id
         || ''', eventType=''' || event_type || ''', timestamp=' || (epoch_us(ts) // 1000) || '}' AS "order"
FROM events""",
        "dedupe_rows": f"SELECT DISTINCT id, ts, vc FROM ({_SENSOR_SQL})",
        "equal_rows": f"""
WITH sensor AS ({_SENSOR_SQL})
SELECT a.event_id,
       (a.id IS NOT DISTINCT FROM b.id AND a.ts IS NOT DISTINCT FROM b.ts
        AND a.vc IS NOT DISTINCT FROM b.vc)::INT AS same
FROM sensor a JOIN sensor b ON a.event_id = b.event_id + 1""",
        "default_amount": """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN floor(value)::INT ELSE 0 END AS amount
FROM events""",
        "event_time": """
SELECT event_id, epoch_us(ts) // 1000 * 1000 AS at_us,
       strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS at_text
FROM events""",
        "fsm_states": _RUN_STATES,
        "fsm_alerts": f"SELECT event_id, text FROM ({_run_text_sql()})",
        "fsm_funnel": _funnel_sql(),
        "fsm_hot_key": _funnel_sql(_HOT),
        "fsm_expiry": _run_states_sql(_sessions_sql()),
        "fsm_expiry_hot_key": _run_states_sql(_sessions_sql(_HOT)),
        "word_count": r"""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
WHERE word <> '' GROUP BY word""",
        # A stream that has come to its end gives what a table gives.
        "stream_pattern": _pattern_sql(),
        "stream_pattern_hot_key": _pattern_sql(_HOT),
        "stream_pattern_ascending": _pattern_sql(_HOT),
        "stream_timeout": f"""
SELECT event_id AS create_id, {timeout_text_sql} AS text
FROM ({_pattern_sql()}) WHERE status = 'timeout'""",
        "stream_run_alert": _run_text_sql(),
        "stream_run_alert_hot_key": _run_text_sql(_HOT),
        "stream_run_alert_expiry": _text_sql(_sessions_sql()),
    }


try:
    import corpus_pipeline
    from sequon.llm import queries as _llm
except ModuleNotFoundError as error:
    # The operators on training text can be left out as a whole; what they need cannot.
    if error.name not in ("corpus_pipeline", "sequon.llm"):
        raise
    _llm = None

if _llm is not None:
    _own_queries, _own_sql = queries, oracle_sql

    def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
        return {**_own_queries(), **_llm.QUERIES, "pipeline": corpus_pipeline.run}

    def oracle_sql() -> dict[str, str]:
        return {**_own_sql(), **_llm.ORACLE_SQL}
