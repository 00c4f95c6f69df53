"""Declared schemas and fixed column lists; nothing in the library is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _DBL, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

RAW_SCHEMA = _struct(
    row_index=_LONG,
    trans_date_trans_time=T.TimestampNTZType(),
    cc_num=_STR,
    merchant=_STR,
    category=_STR,
    amt=_DBL,
    first=_STR,
    last=_STR,
    gender=_STR,
    street=_STR,
    city=_STR,
    state=_STR,
    zip=_STR,
    lat=_DBL,
    long=_DBL,
    city_pop=_LONG,
    job=_STR,
    dob=T.DateType(),
    trans_num=_STR,
    unix_time=_LONG,
    merch_lat=_DBL,
    merch_long=_DBL,
    is_fraud=_INT,
)

EVENT_SCHEMA = _struct(
    transaction_id=_STR,
    cc_num=_STR,
    amount=_DBL,
    category=_STR,
    timestamp=_STR,
    customer_dob=_STR,
    customer_lat=_DBL,
    customer_long=_DBL,
    merchant_lat=_DBL,
    merchant_long=_DBL,
    city_pop=_LONG,
)

LABEL_SCHEMA = _struct(transaction_id=_STR, is_fraud=_INT)

# The data contract of the transaction feed and of the model input.
PII_COLUMNS = ["first", "last", "street", "city", "state", "zip", "gender", "job"]

REPLAY_COLUMNS = [
    "trans_date_trans_time", "cc_num", "category", "amt", "lat", "long",
    "city_pop", "dob", "trans_num", "merch_lat", "merch_long", "is_fraud",
]

CATEGORIES = [
    "entertainment", "food_dining", "gas_transport", "grocery_net", "grocery_pos",
    "health_fitness", "home", "kids_pets", "misc_net", "misc_pos",
    "personal_care", "shopping_net", "shopping_pos", "travel",
]

HISTORY_FEATURES = [
    "card_txn_count_1h", "card_amt_sum_1h", "card_txn_count_24h", "card_amt_sum_24h",
    "seconds_since_last_txn", "amt_vs_card_mean",
]

ROW_FEATURES = [
    "amt", "log_amt", "hour", "is_night", "day_of_week", "age_years", "distance_km", "log_city_pop",
]

NUMERIC_FEATURES = ROW_FEATURES + HISTORY_FEATURES
CATEGORICAL_FEATURES = ["category"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Feature groups switched off one at a time in the ablation report.
FEATURE_GROUPS = {
    "history": HISTORY_FEATURES,
    "amount": [f for f in NUMERIC_FEATURES if "amt" in f],
}

# Features compared week by week with the reference period.
DRIFT_NUMERIC = [
    "amt", "hour", "age_years", "distance_km", "card_txn_count_24h", "card_amt_sum_24h",
    "amt_vs_card_mean", "seconds_since_last_txn",
]
DRIFT_CATEGORICAL = ["is_night", "category"]
