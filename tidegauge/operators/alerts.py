"""Alerts on single transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.expressions import readable_number
from tidegauge.schemas import TRANSACTION_JSON

# The amount above which a transaction is reported, and the text.
THRESHOLD = 1000.0
PREFIX = "Suspicious Transaction: "


def _exceeds(amount: str | Column, threshold: float) -> Column:
    """Whether an amount is above the threshold; NaN is not."""
    number = readable_number(amount)
    return (number > threshold) & ~F.isnan(number)


def alert_text(
    transaction_id: str | Column, amount: str | Column, threshold: float = THRESHOLD
) -> Column:
    """The alert for an amount above ``threshold``, otherwise the empty string.

    An amount that is not a number, or a missing id, gives no alert.
    """
    name = F.col(transaction_id) if isinstance(transaction_id, str) else transaction_id
    text = F.concat(F.lit(PREFIX), name.cast("string"))
    return F.when(_exceeds(amount, threshold), F.coalesce(text, F.lit(""))).otherwise("")


def threshold_alerts(
    frame: DataFrame,
    transaction_id: str = "transaction_id",
    amount: str = "amount",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One ``fraud_result`` per suspicious transaction; works on tables and streams.

    These are the rows whose alert text is not empty.  The condition is put on
    the columns instead of the text, so that a numeric amount is compared in
    the scan.
    """
    suspicious = _exceeds(amount, threshold) & F.col(transaction_id).isNotNull()
    text = F.concat(F.lit(PREFIX), F.col(transaction_id).cast("string"))
    return frame.where(suspicious).select(text.alias("fraud_result"))


def decoded_transactions(raw: DataFrame, value: str = "value") -> DataFrame:
    """Transactions out of JSON text; a malformed line has no id and no amount."""
    return raw.select(
        F.from_json(F.col(value).cast("string"), TRANSACTION_JSON).alias("body")
    ).select("body.*")
