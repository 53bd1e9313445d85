"""Record types of the five event families and of the results derived from them."""

from __future__ import annotations

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_LONG, _INT, _TEXT, _TIME = LongType(), IntegerType(), StringType(), TimestampType()

USER_BEHAVIOR = _struct(user_id=_LONG, item_id=_LONG, category_id=_INT, behavior=_TEXT, ts=_TIME)
WEB_LOG = _struct(ip=_TEXT, user_id=_TEXT, ts=_TIME, method=_TEXT, url=_TEXT)
AD_CLICK = _struct(user_id=_LONG, ad_id=_LONG, province=_TEXT, city=_TEXT, ts=_TIME)
MARKETING = _struct(user_id=_TEXT, behavior=_TEXT, channel=_TEXT, ts=_TIME)
LOGIN = _struct(user_id=_LONG, ip=_TEXT, event_type=_TEXT, ts=_TIME)
ORDER = _struct(order_id=_LONG, event_type=_TEXT, tx_id=_TEXT, ts=_TIME)
RECEIPT = _struct(tx_id=_TEXT, pay_channel=_TEXT, ts=_TIME)
