"""Alert texts. A null prints as null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three alert texts.
RUN_TEXT = "%s 连续三次登录失败"
PAID_TEXT = "订单 %s 已支付！"
TIMEOUT_TEXT = "订单 %s 超时未支付！用户为：%s"


def run_text(user: str | Column) -> Column:
    return F.format_string(RUN_TEXT, user)


def paid_text(order: str | Column) -> Column:
    return F.format_string(PAID_TEXT, order)


def timeout_text(order: str | Column, user: str | Column) -> Column:
    return F.format_string(TIMEOUT_TEXT, order, user)
