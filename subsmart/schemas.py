"""Declared schemas of the four raw sources and of the marts."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


MONEY = T.DecimalType(10, 2)
_LONG, _TEXT, _DATE = T.LongType(), T.StringType(), T.DateType()
_INT, _FLAG, _TIME, _REAL = T.IntegerType(), T.BooleanType(), T.TimestampNTZType(), T.DoubleType()

OBJECT_TOTALS = (
    "total_contacts",
    "total_lists",
    "total_deals",
    "total_landing_pages",
    "total_blogs",
    "total_workflows",
)

SOURCES: dict[str, T.StructType] = {
    "accounts": _schema(
        id=_LONG, name=_TEXT, signup_date=_DATE, country=_TEXT, vertical=_TEXT, nps=_INT
    ),
    "subscriptions": _schema(
        account_id=_LONG,
        start_date=_DATE,
        cancel_date=_DATE,
        product=_TEXT,
        tier=_TEXT,
        monthly_cost=MONEY,
        touchless_conversion=_FLAG,
    ),
    "usage_events": _schema(
        account_id=_LONG,
        user_id=_LONG,
        event_id=_LONG,
        event_time=_TIME,
        product=_TEXT,
        event_type=_TEXT,
    ),
    "object_counts_daily": _schema(
        date=_DATE, account_id=_LONG, **{name: _LONG for name in OBJECT_TOTALS}
    ),
}

MARTS: dict[str, T.StructType] = {
    "dim_dates": _schema(
        date_id=_INT,
        full_date=_DATE,
        day_of_week=_INT,
        day_name=_TEXT,
        day_of_month=_INT,
        week_number=_INT,
        month=_INT,
        month_name=_TEXT,
        quarter=_INT,
        year=_INT,
        is_weekend=_FLAG,
        is_holiday=_FLAG,
    ),
    "dim_tiers": _schema(tier_id=_TEXT, tier_name=_TEXT, tier_price=MONEY),
    "dim_products": _schema(product_id=_TEXT, product_name=_TEXT),
    "dim_accounts": _schema(
        account_id=_LONG,
        name=_TEXT,
        signup_date_id=_INT,
        country=_TEXT,
        vertical=_TEXT,
        nps=_INT,
        start_date_id=_INT,
        end_date_id=_INT,
        is_current=_FLAG,
    ),
    "fact_object_counts": _schema(
        account_id=_LONG, usage_date=_DATE, **{name: _LONG for name in OBJECT_TOTALS}
    ),
    "fact_product_usage": _schema(
        account_id=_LONG,
        product_id=_TEXT,
        usage_date_day=_DATE,
        total_usage_events=_LONG,
        total_activations=_LONG,
        active_users=_LONG,
    ),
    "fact_financials": _schema(
        account_id=_LONG,
        product_id=_TEXT,
        tier_id=_TEXT,
        financial_month=_DATE,
        total_revenue=_REAL,
        active_subscriptions=_LONG,
        churned_subscriptions=_LONG,
    ),
}

# Column whose values a fact batch replaces; also the fact's partition column.
REPLACE_KEYS = {
    "fact_object_counts": "usage_date",
    "fact_product_usage": "usage_date_day",
    "fact_financials": "financial_month",
}

# Sets of users by day, product and bucket of user numbers; built on demand.
REPLACE_KEYS["usage_user_sets"] = "usage_date_day"
USER_SETS = _schema(usage_date_day=_DATE, product_id=_TEXT, user_bucket=_LONG, users=T.BinaryType())

# Prints of what each fact was built from, by its replace key.
PRINTS = {name: f"{name}_prints" for name in REPLACE_KEYS}
STATE: dict[str, T.StructType] = {
    "usage_user_sets": USER_SETS,
    **{name: _schema(key=_DATE, print=_TEXT) for name in PRINTS.values()},
}
