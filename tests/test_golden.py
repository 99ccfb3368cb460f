"""The two jobs and the text lines on their small inputs, to the letter."""

from datetime import timedelta

from pyspark.sql import functions as F

from sequon.functions.alerts import paid_text, run_text, timeout_text
from sequon.functions.times import ascending, event_time
from sequon.model import LOGIN, ORDER
from sequon.operators.machine import machine_alerts, run_alert_machine, run_machine
from sequon.operators.runs import run_alerts
from sequon.operators.sequence import Pattern, Step, as_map, by_status, match, step_row
from sequon.operators.words import word_count
from sequon.sources.sinks import labelled
from sequon.sources.tables import from_rows

LOGINS = [
    ("user_1", "192.168.0.1", "fail", 2000, 0),
    ("user_1", "192.168.0.2", "fail", 3000, 0),
    ("user_2", "192.168.1.29", "fail", 4000, 0),
    ("user_1", "171.56.23.10", "fail", 5000, 0),
    ("user_2", "192.168.1.29", "success", 6000, 0),
    ("user_2", "192.168.1.29", "fail", 7000, 0),
    ("user_2", "192.168.1.29", "fail", 8000, 0),
]
ORDERS = [
    ("user_1", "order_1", "create", 1000),
    ("user_2", "order_2", "create", 2000),
    ("user_1", "order_1", "modify", 10_000),
    ("user_1", "order_1", "pay", 60_000),
    ("user_2", "order_3", "create", 600_000),
    ("user_2", "order_3", "pay", 1_200_000),
]


def paying():
    kind = F.col("event_type")
    return Pattern(
        Step("create", kind == "create"), Step("pay", kind == "pay"), timedelta(minutes=15)
    )


def orders(spark, rows=ORDERS):
    return from_rows(spark, rows, ORDER).withColumn("at", event_time("timestamp"))


def test_failed_logins_by_runs(spark):
    logins = from_rows(spark, LOGINS, LOGIN)
    alerts = run_alerts(logins, ["user_id"], ["timestamp"], F.col("event_type") == "fail")
    texts = labelled(alerts.select("timestamp", run_text("user_id").alias("text")), "warning")
    assert [tuple(r) for r in texts.collect()] == [("warning", 5000, "user_1 连续三次登录失败")]


def test_failed_logins_by_machine(spark):
    logins = from_rows(spark, LOGINS, LOGIN)
    machine = run_alert_machine("fail", "success")
    kind = F.col("event_type")
    alerts = machine_alerts(logins, machine, ["user_id"], ["timestamp"], kind)
    assert [(r.user_id, r.timestamp) for r in alerts.collect()] == [("user_1", 5000)]
    traced = run_machine(logins, machine, ["user_id"], ["timestamp"], kind)
    last = traced.groupBy("user_id").agg(F.max_by("state", "timestamp").alias("state"))
    assert {r.user_id: r.state for r in last.collect()} == {"user_1": "S2", "user_2": "S2"}


def test_paid_and_timed_out_orders(spark):
    found = match(orders(spark), paying(), ["order_id"], "at", "timestamp")
    paid = by_status(found, "payed").select(paid_text("pay.order_id").alias("text"))
    late = by_status(found, "timeout").select(
        timeout_text("create.order_id", "create.user_id").alias("text")
    )
    assert sorted(r.text for r in paid.collect()) == ["订单 order_1 已支付！", "订单 order_3 已支付！"]
    assert [r.text for r in late.collect()] == ["订单 order_2 超时未支付！用户为：user_2"]


def test_match_as_map(spark):
    found = as_map(match(orders(spark), paying(), ["order_id"], "at", "timestamp"), paying())
    steps = F.col("match")
    rows = found.select(
        step_row(steps, "create")["timestamp"], step_row(steps, "pay")["timestamp"], F.size(steps)
    )
    assert sorted(tuple(r) for r in rows.collect()) == [
        (1000, 60_000, 2),
        (2000, None, 1),
        (600_000, 1_200_000, 2),
    ]


def test_missing_user_prints_null(spark):
    rows = [(None, "order_9", "create", 1000)]
    found = match(orders(spark, rows), paying(), ["order_id"], "at", "timestamp")
    text = found.select(timeout_text("create.order_id", "create.user_id").alias("text")).first().text
    assert text == "订单 order_9 超时未支付！用户为：null"


def test_words(spark):
    lines = spark.createDataFrame([("hello spark",), ("hello  world ",), (" hello java",)], "value string")
    counts = {r.word: r.n for r in word_count(lines).collect()}
    assert counts == {"hello": 3, "spark": 1, "world": 1, "java": 1}


def test_ascending_watermark(spark):
    stream = spark.readStream.format("rate").load()
    plan = ascending(stream, "timestamp")._jdf.queryExecution().analyzed().toString()
    assert "0.001 seconds" in plan
