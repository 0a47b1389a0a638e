"""Declared row types; nothing is inferred from data."""

from __future__ import annotations

# Column names, types and order of the inputs and results.
USER_BEHAVIOR_CSV = "userId bigint, itemId bigint, categoryId bigint, behavior string, timestamp bigint"
USER_BEHAVIOR_JSON = "user_id string, item_id string, category_id string, behavior string, ts timestamp"
VISIT = "date string, eventId string, timestamp bigint"
BILL = "userId string, price double, timestamp bigint"
WORD_EVENT = "word string, frequency int, timestamp bigint"
USER = "userId string, username string, timestamp bigint"
ORDER = "orderId string, userId string, timestamp bigint"
DETAIL = "username string, orderId string, timestamp bigint"
PRODUCT_ORDER = "orderId string, product string, orderTime bigint"
PAYMENT = "orderId string, payType string, payTime bigint"
DIMENSION_ORDER = "orderId string, userId int, opTime bigint"
DIMENSION_USER = "id int, username string"
DIMENSION_DETAIL = "orderId string, userId int, username string, opTime bigint"
TIMED_USER = "id string, name string, opTime timestamp"
TABLE_USER = "id string, name string, ts bigint"
ACCESS_LOG = "accessTime bigint, region string, userId string"
REGION_PV = "region string, winStart timestamp, winEnd timestamp, pv bigint"
PRODUCT_AMOUNT = "productId bigint, amount int"
PURCHASE = "user bigint, product string, amount int"
PV_UV = "dt string, pv bigint, uv bigint"
TEXT_LINE = "value string"
