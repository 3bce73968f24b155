"""The checks declared for the sources and marts.

Fixed values: which column carries which check.
"""

from __future__ import annotations

from subsmart.operators.quality import (
    EXPRESSION,
    NOT_NULL,
    NOT_NULL_WHERE,
    RELATIONSHIPS,
    UNIQUE,
    Check,
)

UNIQUE_COLUMNS = [
    "accounts.id",
    "usage_events.event_id",
    "dim_tiers.tier_id",
    "dim_accounts.account_id",
    "dim_products.product_id",
]

NOT_NULL_COLUMNS = {
    "accounts": "id signup_date",
    "subscriptions": "account_id start_date",
    "usage_events": "account_id event_id event_time",
    "object_counts_daily": "date account_id",
    "dim_tiers": "tier_id tier_name tier_price start_date_id is_current",
    "dim_accounts": "account_id name signup_date_id country vertical nps start_date_id is_current",
    "dim_products": "product_id product_name",
    "fact_financials": "account_id product_id tier_id financial_month "
    "total_revenue active_subscriptions churned_subscriptions",
    "fact_product_usage": "account_id product_id usage_date_day "
    "total_usage_events total_activations active_users",
}

NOT_NULL_WHERE_COLUMNS = {
    "dim_tiers.end_date_id": "end_date_id IS NOT NULL",
    "dim_accounts.end_date_id": "end_date_id IS NOT NULL",
}

PARENTS = {
    "subscriptions.account_id": "accounts.id",
    "usage_events.account_id": "accounts.id",
    "object_counts_daily.account_id": "accounts.id",
    "dim_tiers.start_date_id": "dim_dates.date_id",
    "dim_tiers.end_date_id": "dim_dates.date_id",
    "dim_accounts.signup_date_id": "dim_dates.date_id",
    "dim_accounts.start_date_id": "dim_dates.date_id",
    "dim_accounts.end_date_id": "dim_dates.date_id",
    "fact_financials.account_id": "dim_accounts.account_id",
    "fact_financials.product_id": "dim_products.product_id",
    "fact_financials.tier_id": "dim_tiers.tier_id",
    "fact_financials.financial_month": "dim_dates.full_date",
    "fact_product_usage.account_id": "dim_accounts.account_id",
    "fact_product_usage.product_id": "dim_products.product_id",
    "fact_product_usage.usage_date_day": "dim_dates.full_date",
}

NOT_NEGATIVE = [
    "fact_financials.total_revenue",
    "fact_financials.active_subscriptions",
    "fact_financials.churned_subscriptions",
    "fact_product_usage.total_usage_events",
    "fact_product_usage.total_activations",
    "fact_product_usage.active_users",
]

# An account has one row per version, so the plain check fails once an account has changed;
# its id is unique among current ones.
UNIQUE_WHERE_COLUMNS = {"dim_accounts.account_id": "is_current"}


def _split(name: str) -> tuple[str, str]:
    table, column = name.split(".")
    return table, column


CHECKS: list[Check] = [
    *(Check(*_split(name), UNIQUE) for name in UNIQUE_COLUMNS),
    *(Check(*_split(name), UNIQUE, rows) for name, rows in UNIQUE_WHERE_COLUMNS.items()),
    *(
        Check(table, column, NOT_NULL)
        for table, columns in NOT_NULL_COLUMNS.items()
        for column in columns.split()
    ),
    *(Check(*_split(name), NOT_NULL_WHERE, f) for name, f in NOT_NULL_WHERE_COLUMNS.items()),
    *(Check(*_split(name), RELATIONSHIPS, parent) for name, parent in PARENTS.items()),
    *(Check(*_split(name), EXPRESSION, ">= 0") for name in NOT_NEGATIVE),
]
