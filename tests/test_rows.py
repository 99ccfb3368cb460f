"""Lines, rendering, equality, defaults, keys."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from sequon.functions.rows import (
    LOGIN_FORM,
    ORDER_FORM,
    SENSOR_FORM,
    distinct_rows,
    render,
    same_row,
    with_defaults,
)
from sequon.model import LOGIN, ORDER, SENSOR, counted_keys, split_null_keys
from sequon.operators.words import word_count
from sequon.sources.lines import parse_lines, parse_or_quarantine
from sequon.sources.sinks import read_output, to_console, write_outputs
from sequon.sources.tables import from_rows

GOOD = {
    "s1,1,2": ("s1", 1, 2),
    "s1,+5,2": ("s1", 5, 2),
    "s1,1,2,9": ("s1", 1, 2),
    "s1,1,2,,": ("s1", 1, 2),
    ",1,-2": ("", 1, -2),
    " s 1 ,1,2": (" s 1 ", 1, 2),
    "s1,-9223372036854775808,2147483647": ("s1", -(2**63), 2**31 - 1),
}
BAD = [
    "",
    "s1",
    "s1,1",
    "s1,,2",
    "s1, 1,2",
    "s1,1,2 ",
    "s1,1.0,2",
    "s1,1,2147483648",
    "s1,9223372036854775808,2",
    '"a,b",1,2',
    "s1,1,2\r",
    "s1,1,2\n",
    "a,,",
    "s1,+,2",
    None,
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_good_lines(spark):
    found = parse_lines(lines(spark, GOOD))
    assert found.schema == SENSOR
    assert [tuple(r) for r in found.collect()] == list(GOOD.values())


@pytest.mark.parametrize("line", BAD)
def test_bad_line_fails(spark, line):
    with pytest.raises(PySparkException):
        parse_lines(lines(spark, [line])).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", BAD)
def test_bad_line_fails_whatever_is_read(spark, line, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = parse_lines(lines(spark, [*GOOD, line]))
        for run in (found.count, found.select("id").collect, found.groupBy("id").count().collect):
            with pytest.raises(PySparkException):
                run()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_quarantine(spark):
    good, bad = parse_or_quarantine(lines(spark, [*GOOD, *BAD]))
    assert good.schema == SENSOR
    assert [tuple(r) for r in good.collect()] == list(GOOD.values())
    assert [r.value for r in bad.collect()] == BAD


def test_rendering(spark):
    login = from_rows(spark, [("u", "ip", "fail", 1, 0), (None, None, None, None, 3)], LOGIN)
    order = from_rows(spark, [("u", "o", "pay", 1)], ORDER)
    sensor = from_rows(spark, [("s", None, 2)], SENSOR)

    def texts(df, form):
        return [r.text for r in df.select(render(form, *df.columns).alias("text")).collect()]

    assert texts(login, LOGIN_FORM) == [
        "LoginEvent{userId='u', ipAddress='ip', eventType='fail', timestamp=1, amount=0}",
        "LoginEvent{userId='null', ipAddress='null', eventType='null', timestamp=null, amount=3}",
    ]
    assert texts(order, ORDER_FORM) == [
        "OrderEvent{userId='u'orderId='o', eventType='pay', timestamp=1}"
    ]
    assert texts(sensor, SENSOR_FORM) == ["WaterSensor{id='s', ts=null, vc=2}"]


def test_equal_rows(spark):
    rows = [("a", None, 1), ("a", None, 1), ("a", 1, 1), (None, None, None), (None, None, None)]
    sensors = from_rows(spark, rows, SENSOR)
    found = distinct_rows(sensors, ["id", "ts", "vc"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(set(rows), key=repr)
    left, right = sensors.alias("l"), from_rows(spark, rows[1:3], SENSOR).alias("r")
    assert left.join(right, same_row(left, right, ["id", "ts", "vc"])).count() == 3


def test_defaults(spark):
    short = from_rows(spark, [("u", "ip", "fail", 1)], LOGIN[:4])
    full = with_defaults(short, {"amount": 0})
    assert full.first().amount == 0 and not full.schema["amount"].nullable
    given = from_rows(spark, [("u", "ip", "fail", 1, None), ("u", "ip", "fail", 1, 7)], LOGIN)
    given = with_defaults(given, {"amount": 0})
    assert [r.amount for r in given.collect()] == [0, 7]
    assert given.schema["amount"].dataType == LOGIN["amount"].dataType
    assert not given.schema["amount"].nullable


def test_null_keys(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("b", None)], "k string, n int")
    taken, refused = split_null_keys(rows, ["k", "n"])
    assert (taken.count(), refused.count()) == (1, 2)
    seen = Observation()
    assert counted_keys(rows, ["k"], seen).count() == 2
    assert seen.get == {"accepted": 2, "rejected": 1}


def test_outputs_have_their_own_folders(spark, tmp_path):
    rows = spark.createDataFrame([(1, "payed"), (2, "timeout")], "id int, status string")
    write_outputs(rows, str(tmp_path / "out"))
    assert [r.id for r in read_output(spark, str(tmp_path / "out"), "timeout").collect()] == [2]


def test_console_prints_every_row(spark, capsys):
    to_console(spark.range(25).toDF("id"), "payed")
    assert capsys.readouterr().out.split("\n") == [*(f"payed\t{i}" for i in range(25)), ""]
    to_console(spark.range(25).toDF("id"), "payed", rows=3)
    assert capsys.readouterr().out.count("payed") == 3


def test_outputs_are_not_overwritten_unasked(spark, tmp_path):
    rows = spark.createDataFrame([(1, "payed")], "id int, status string")
    write_outputs(rows, str(tmp_path / "out"))
    with pytest.raises(PySparkException):
        write_outputs(rows, str(tmp_path / "out"))
    write_outputs(rows, str(tmp_path / "out"), mode="overwrite")


def test_streams_need_a_checkpoint(spark, tmp_path):
    stream = spark.readStream.format("rate").load().selectExpr("value", "'payed' AS status")
    with pytest.raises(ValueError, match="checkpoint"):
        write_outputs(stream, str(tmp_path / "out"))


def test_words_of_nothing(spark):
    assert word_count(lines(spark, ["", "  ", None])).count() == 0
