"""SQL counterparts of the queries, over the raw tables, for DuckDB.

They take the long way on purpose: revenue is derived day by day, versions are
derived batch by batch, and every check counts its own failures.
"""

from __future__ import annotations

from subsmart.operators.quality import EXPRESSION, NOT_NULL, NOT_NULL_WHERE, RELATIONSHIPS, UNIQUE
from subsmart.plans.checks import CHECKS
from subsmart.schemas import OBJECT_TOTALS

# Relations that later ones and the queries refer to, in dependency order.
RELATIONS: dict[str, str] = {
    "accounts": """
        select c_custkey as id, c_name as name, first_order.day as signup_date,
               n_name as country, c_mktsegment as vertical, cast(c_custkey % 11 as integer) as nps
        from customer
        left join nation on n_nationkey = c_nationkey
        left join (select o_custkey, cast(min(o_orderdate) as date) as day
                   from orders group by o_custkey) first_order on o_custkey = c_custkey""",
    "subscriptions": """
        select o_custkey as account_id, cast(o_orderdate as date) as start_date,
               case when o_orderstatus = 'O' then null
                    when o_orderkey % 97 = 0 then cast(o_orderdate as date) - 1
                    else cast(o_orderdate as date) + cast(o_orderkey % 120 as integer)
               end as cancel_date,
               case o_orderkey % 6 when 0 then 'Marketing' when 1 then 'Sales' when 2 then 'Service'
                    when 3 then 'Content' when 4 then 'Operations' else 'Beta' end as product,
               case o_orderpriority when '1-URGENT' then 'Enterprise'
                    when '2-HIGH' then 'Professional' when '3-MEDIUM' then 'Starter'
                    when '5-LOW' then 'Trial' end as tier,
               cast(case o_orderpriority when '1-URGENT' then 1200 when '2-HIGH' then 450.5
                    when '3-MEDIUM' then 20 when '5-LOW' then 0 end as decimal(10,2))
                   as monthly_cost,
               o_orderkey % 2 = 0 as touchless_conversion
        from (select *, unnest(case when o_orderkey % 50 = 0 then [1, 2] else [1] end) as copy
              from orders)""",
    "usage_events": """
        select user_id % 50 as account_id, user_id, event_id, ts as event_time,
               case event_id % 6 when 0 then 'Marketing' when 1 then 'Sales' when 2 then 'Service'
                    when 3 then 'Content' when 4 then 'Operations' end as product,
               case event_type when 'signup' then 'Activation' when 'error' then 'Error'
                    else 'Usage' end as event_type
        from events""",
    "object_counts_daily": """
        select cast(l_shipdate as date) as date, l_suppkey as account_id,
               cast(floor(l_quantity) as bigint) as total_contacts,
               cast(l_linenumber as bigint) as total_lists,
               cast(floor(l_extendedprice / 1000) as bigint) as total_deals,
               l_orderkey % 7 as total_landing_pages, l_orderkey % 5 as total_blogs,
               l_partkey % 3 as total_workflows
        from lineitem""",
    "limits": """
        select cast(date_trunc('year', (select min(o_orderdate) from orders)) as date) as first_day,
               make_date(year((select max(ts) from events)) + 3, 12, 31) as last_day,
               cast((select max(o_orderdate) from orders) as date) as last_order""",
    "dim_dates": """
        select cast(strftime(d, '%Y%m%d') as integer) as date_id, d as full_date,
               cast(dayofweek(d) + 1 as integer) as day_of_week, dayname(d) as day_name,
               cast(day(d) as integer) as day_of_month,
               cast(weekofyear(d) as integer) as week_number,
               cast(month(d) as integer) as month, monthname(d) as month_name,
               cast(quarter(d) as integer) as quarter, cast(year(d) as integer) as year,
               dayofweek(d) in (0, 6) as is_weekend, false as is_holiday
        from (select cast(unnest(generate_series(first_day, last_day, interval 1 day)) as date) as d
              from limits)""",
    "dim_tiers": """
        select distinct md5(tier || '-' || cast(monthly_cost as varchar)) as tier_id,
               tier as tier_name, monthly_cost as tier_price
        from subscriptions where tier is not null and monthly_cost is not null""",
    "dim_products": """
        select distinct md5(product) as product_id, product as product_name
        from usage_events where product is not null""",
    "keyed_subscriptions": """
        select s.*, tier_id, product_id
        from subscriptions s
        left join dim_tiers on tier_name = tier and tier_price = monthly_cost
        left join dim_products on product_name = product""",
}

PERIOD = "account_id, product, tier, monthly_cost, start_date, cancel_date"


GAPPED = """not (year(full_date) = 1997 and month(full_date) in (6, 7, 8))
              and day(full_date) <= 28 and year(full_date) >= 1996"""


def _financial_relations(
    until: str = "cancel_date", source: str = "keyed_subscriptions", days: str = "true"
) -> dict:
    """Revenue day by day: every covered day of every distinct subscription is a row."""
    return {
        "covered": f"""
            select *, cast(date_trunc('month', full_date) as date) as financial_month
            from (select distinct {PERIOD}, tier_id, product_id,
                         cast(unnest(generate_series(start_date, {until}, interval 1 day)) as date)
                             as full_date
                  from {source}, limits where start_date <= {until})
            where full_date >= (select first_day from limits)
              and full_date <= (select last_day from limits) and {days}""",
        "account_load": """
            select account_id, financial_month, count(*) as days_active
            from covered group by account_id, financial_month""",
        "own_load": f"""
            select {PERIOD}, tier_id, product_id, financial_month, count(*) as days_covered,
                   cast(day(last_day(financial_month)) as integer) as total_days,
                   coalesce(date_trunc('month', cancel_date) = financial_month, false) as ends_here
            from covered group by all""",
        "revenue": """
            select own_load.*, days_active,
                   case when ends_here
                        then cast(monthly_cost as double)
                             * (cast(days_active as double) / total_days)
                        else cast(monthly_cost as double) end as shared_revenue,
                   case when ends_here
                        then cast(monthly_cost as double)
                             * (cast(days_covered as double) / total_days)
                        else cast(monthly_cost as double) end as own_revenue
            from own_load join account_load using (account_id, financial_month)""",
    }


def _with(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the relations it needs, directly or through others."""
    known = {**RELATIONS, **(extra or {})}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in known:
            if name in words and name not in needed:
                needed.add(name)
                visit(known[name])

    visit(body)
    parts = [f"{name} as ({sql})" for name, sql in known.items() if name in needed]
    return f"with {', '.join(parts)} {body}" if parts else body


def _fact(revenue: str, **options: str) -> str:
    return _with(
        f"""select account_id, product_id, tier_id, financial_month,
                   round(sum({revenue}), 4) as total_revenue,
                   count(distinct account_id) as active_subscriptions,
                   count(distinct case when ends_here then account_id end) as churned_subscriptions
            from revenue group by account_id, product_id, tier_id, financial_month""",
        _financial_relations(**options),
    )


# Staged accounts as the batches deliver them, the first load being batch 0.
BATCHES = {
    "batch0": """
        select id as account_id, name, date_id as signup_date_id, country, vertical, nps
        from accounts join dim_dates on full_date = signup_date""",
    "batch1": """
        select account_id, name, signup_date_id, country,
               case when account_id % 10 = 0 then 'SOFTWARE' else vertical end as vertical, nps
        from batch0""",
    "batch2": """
        select account_id, name, signup_date_id, country, vertical,
               case when account_id % 15 <> 0 then nps end as nps
        from batch1""",
    # An account's versions: its first state, then each batch state unlike the one before.
    "deliveries": """
        select *, 0 as seq, signup_date_id as start_date_id from batch0
        union all select *, 1, 20020101 from batch1
        union all select *, 2, 20030101 from batch2""",
    "compared": """
        select *, lag(struct_pack(country, vertical, nps)) over (
                      partition by account_id order by seq) as former
        from deliveries""",
    "versions": """
        select * from compared
        where seq = 0 or former is distinct from struct_pack(country, vertical, nps)""",
    "dim_accounts": """
        select account_id, name, signup_date_id, country, vertical, nps, start_date_id,
               lead(start_date_id) over (partition by account_id order by seq) as end_date_id,
               lead(seq) over (partition by account_id order by seq) is null as is_current
        from versions""",
}

USAGE_DAY = """
    select account_id, product_id, cast(event_time as date) as usage_date_day,
           cast(count(*) filter (event_type = 'Usage') as bigint) as total_usage_events,
           cast(count(*) filter (event_type = 'Activation') as bigint) as total_activations,
           count(distinct {who}) as active_users
    from {events} join dim_products on product_name = product
    where event_type in ('Usage', 'Activation')
    group by 1, 2, 3"""

OBJECT_DAY = """
    select account_id, date as usage_date, {totals}
    from {source} group by account_id, date""".format(
    totals=", ".join(f"cast(sum({name}) as bigint) as {name}" for name in OBJECT_TOTALS),
    source="{source}",
)

MARTS = {
    **BATCHES,
    **_financial_relations(),
    "fact_financials": """
        select account_id, product_id, tier_id, financial_month,
               sum(shared_revenue) as total_revenue,
               count(distinct account_id) as active_subscriptions,
               count(distinct case when ends_here then account_id end) as churned_subscriptions
        from revenue group by account_id, product_id, tier_id, financial_month""",
    "fact_product_usage": USAGE_DAY.format(who="account_id", events="usage_events"),
}

# Columns the checks name although the tier dimension has no such column.
TIER_COLUMNS = {"tier_id", "tier_name", "tier_price"}


def _check_row(check) -> str:
    column, table = check.column, check.table
    if table == "dim_tiers" and column not in TIER_COLUMNS:
        failures = "null"
    elif check.kind == NOT_NULL:
        failures = f"(select count(*) from {table} where {column} is null)"
    elif check.kind == NOT_NULL_WHERE:
        failures = f"(select count(*) from {table} where ( {check.argument} ) and {column} is null)"
    elif check.kind == EXPRESSION:
        failures = f"(select count(*) from {table} where not ( {column} {check.argument} ))"
    elif check.kind == UNIQUE:
        rows = check.argument or "true"
        failures = f"""(select count(*) from (select {column} from {table}
            where {column} is not null and {rows} group by {column} having count(*) > 1))"""
    else:
        parent, field = check.argument.split(".")
        failures = f"""(select count(*) from {table} as child where child.{column} is not null
            and not exists (select 1 from {parent} as parent
                            where parent.{field} = child.{column}))"""
    return f"""select '{table}' as "table", '{column}' as "column", '{check.label}' as "check",
        cast( {failures} as bigint) as failures"""


def _checks(*kinds: str) -> str:
    rows = " union all ".join(_check_row(c) for c in CHECKS if c.kind in kinds)
    return _with(
        f"""select "table", "column", "check",
                   case when failures is null then 'missing_column'
                        when failures = 0 then 'pass' else 'fail' end as status, failures
            from ({rows})""",
        MARTS,
    )


def _replaced(old: str, new: str, key: str, extra: dict[str, str]) -> str:
    return _with(
        f"""select * from new_rows union all
            select * from old_rows where {key} not in (select {key} from new_rows)""",
        {**extra, "old_rows": old, "new_rows": new},
    )


_FINANCIALS = _financial_relations()
_HISTORY = "account_id, name, signup_date_id, country, vertical, nps"

# Users of known products, by day.
_SEEN = {
    "seen": """
        select cast(event_time as date) as day, product_id, user_id
        from usage_events join dim_products on product_name = product
        where event_type in ('Usage', 'Activation') and user_id is not null"""
}


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: a fold over its bytes, eight shifts a byte."""
    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    byte = f"list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: {step})"
    octets = f"list_transform(range(1, length({text}) + 1), lambda i: ascii({text}[i])::bigint)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::bigint, {octets}), lambda a, b: {byte}))"


_NUMBER = _crc32("concat_ws('/', account_id, start_date, product)")
_FAULTS = {
    "texts": f"""
        select *, {_NUMBER} as number from subscriptions""",
    "faults": """
        select *, list_filter([
            case when number % 31 = 0 then 'account_id: missing' end,
            case when number % 29 = 0 then 'start_date: not a date' end,
            case when number % 17 = 0 then 'monthly_cost: not a decimal(10,2)' end,
            case when number % 23 = 0 then 'touchless_conversion: not a boolean' end
        ], lambda x: x is not null) as reasons from texts""",
}

ORACLES: dict[str, str] = {
    "stg_accounts": _with(
        "select id as account_id, name, signup_date, country, vertical, nps from accounts"
    ),
    "stg_subscriptions": _with("select * from subscriptions"),
    "stg_usage_events": _with("select * from usage_events"),
    "stg_object_counts_daily": _with("select * from object_counts_daily"),
    "surrogate_key": _with(
        """select account_id, start_date,
                  md5(coalesce(product, '_dbt_utils_surrogate_key_null_')) as product_key,
                  md5(coalesce(tier, '_dbt_utils_surrogate_key_null_') || '-' ||
                      coalesce(cast(monthly_cost as varchar), '_dbt_utils_surrogate_key_null_'))
                      as offer_key
           from subscriptions"""
    ),
    "calendar_rows": """
        select cast(unnest(generate_series(a, b, interval 1 day)) as date) as full_date
        from (select cast(min(l_shipdate) as date) as a, cast(max(l_shipdate) as date) as b
              from lineitem)""",
    "dim_dates": _with("select * from dim_dates"),
    "calendar_extend": _with("select * from dim_dates"),
    "calendar_upsert": _with(
        """select * replace (is_weekend and year >= (select year(max(ts)) + 2 from events)
                             as is_holiday) from dim_dates"""
    ),
    "dim_tiers": _with("select * from dim_tiers"),
    "dim_tiers_faithful": _with(
        """select md5(concat(tier, '-', monthly_cost)) as tier_id, tier as tier_name,
                  monthly_cost as tier_price
           from subscriptions where tier is not null and monthly_cost is not null"""
    ),
    "dim_products": _with("select * from dim_products"),
    "latest_accounts": _with(
        """select id as account_id, name, country, vertical, nps,
                  min(signup_date) as first_signup_date
           from accounts group by id, name, country, vertical, nps"""
    ),
    "account_signup_date_id": _with("select account_id, name, signup_date_id from batch0", BATCHES),
    "scd2_first_load": _with(
        f"""select {_HISTORY}, signup_date_id as start_date_id,
                   cast(null as integer) as end_date_id, true as is_current
            from batch0""",
        BATCHES,
    ),
    "scd2_changed_rows": _with(
        f"""select {_HISTORY} from batch1 where not exists (
                select 1 from batch0 where batch0.account_id = batch1.account_id
                and batch0.country is not distinct from batch1.country
                and batch0.vertical is not distinct from batch1.vertical
                and batch0.nps is not distinct from batch1.nps)""",
        BATCHES,
    ),
    "scd2_version_chain": _with("select * from dim_accounts", BATCHES),
    "scd2_second_batch": _with("select * from dim_accounts", BATCHES),
    "scd2_changed_accounts": _with("select * from dim_accounts", BATCHES),
    "fact_object_counts": _with(OBJECT_DAY.format(source="object_counts_daily")),
    "usage_event_filter": _with(
        """select account_id, user_id, product as product_name, event_time, event_type
           from usage_events where event_type <> 'Error'"""
    ),
    "usage_with_product": _with(
        """select account_id, user_id, md5(product) as product_id, product as product_name,
                  cast(event_time as date) as usage_date_day, event_time, event_type
           from usage_events where event_type <> 'Error' and product is not null"""
    ),
    "fact_product_usage": _with(USAGE_DAY.format(who="account_id", events="usage_events")),
    "fact_product_usage_users": _with(USAGE_DAY.format(who="user_id", events="usage_events")),
    "usage_user_sets": _with(
        """select day as usage_date_day, product_id,
                  cast(case when user_id > 0 then (user_id - 1) // 32768 + 1
                       else user_id // 32768 end as bigint) as user_bucket,
                  count(distinct user_id) as n_users
           from seen group by all""",
        _SEEN,
    ),
    "monthly_active_users": _with(
        """select cast(date_trunc('month', day) as date) as usage_month, product_id,
                  count(distinct user_id) as active_users
           from seen group by 1, 2""",
        _SEEN,
    ),
    "product_active_users": _with(
        "select product_id, count(distinct user_id) as active_users from seen group by 1", _SEEN
    ),
    "weekly_trailing_users": _with(
        """select d.day as usage_date_day, d.product_id, count(distinct s.user_id) as active_users
           from (select distinct day, product_id from seen) d
           join seen s on s.product_id = d.product_id and s.day between d.day - 6 and d.day
           group by 1, 2""",
        _SEEN,
    ),
    "accepted_subscriptions": _with(
        "select * exclude (number, reasons) from faults where len(reasons) = 0", _FAULTS
    ),
    "rejected_subscriptions": _with(
        """select case when number % 31 <> 0 then cast(account_id as varchar) end as account_id,
                  product, array_to_string(reasons, '; ') as reasons, count(*) as n
           from faults where len(reasons) > 0 group by all""",
        _FAULTS,
    ),
    "dq_rejects": _with(
        """select 'subscriptions' as "table", split_part(reason, ':', 1) as "column",
                  'schema: ' || reason as "check", 'fail' as status, count(*) as failures
           from (select unnest(reasons) as reason from faults) group by reason""",
        _FAULTS,
    ),
    "subscription_events": _with(
        f"select {PERIOD}, tier_id, product_id from keyed_subscriptions"
    ),
    "subscription_days": _with(f"select {PERIOD}, full_date from covered", _FINANCIALS),
    "subscription_months": _with(
        f"select {PERIOD}, financial_month, cast(days_covered as integer) as days_covered, "
        "total_days from own_load",
        _FINANCIALS,
    ),
    "financials_days_active": _with(
        f"select {PERIOD}, financial_month, days_active, total_days from revenue", _FINANCIALS
    ),
    "financials_prorated": _with(
        f"select {PERIOD}, financial_month, round(shared_revenue, 4) as adjusted_revenue "
        "from revenue",
        _FINANCIALS,
    ),
    "financials_churn": _with(
        """select account_id, financial_month, count(distinct account_id) as active_subscriptions,
                  count(distinct case when ends_here then account_id end) as churned_subscriptions
           from own_load group by account_id, financial_month""",
        _FINANCIALS,
    ),
    "financials_churn_by_offer": _with(
        """select account_id, product_id, tier_id, financial_month,
                  count(distinct account_id) as active_subscriptions,
                  count(distinct case when ends_here then account_id end) as churned_subscriptions
           from own_load group by account_id, product_id, tier_id, financial_month""",
        _FINANCIALS,
    ),
    "fact_financials_gapped_calendar": _fact("shared_revenue", days=GAPPED),
    "subscription_days_gapped_calendar": _with(
        f"select {PERIOD}, full_date from covered", _financial_relations(days=GAPPED)
    ),
    "days_active_gapped_calendar": _with(
        f"select {PERIOD}, financial_month, days_active from revenue",
        _financial_relations(days=GAPPED),
    ),
    "fact_financials": _fact("shared_revenue"),
    "fact_financials_open": _fact("shared_revenue", until="coalesce(cancel_date, last_order)"),
    "fact_financials_per_subscription": _fact("own_revenue"),
    "replace_object_counts": _replaced(
        OBJECT_DAY.format(source="object_counts_daily"),
        OBJECT_DAY.format(source="corrected"),
        "usage_date",
        {
            "corrected": """
                select * replace (total_contacts + 1 as total_contacts)
                from object_counts_daily where date >= date '2000-01-01'"""
        },
    ),
    "replace_product_usage": _replaced(
        USAGE_DAY.format(who="account_id", events="usage_events"),
        USAGE_DAY.format(who="account_id", events="corrected"),
        "usage_date_day",
        {
            "corrected": """
                select * replace (replace(event_type, 'Usage', 'Activation') as event_type)
                from usage_events where event_time >= timestamp '2024-01-16'"""
        },
    ),
    "replace_financials": f"""
        with old_rows as ({_fact("shared_revenue")}),
             new_rows as (select * from ({
                 _with(
                     '''select account_id, product_id, tier_id, financial_month,
                               round(sum(shared_revenue), 4) as total_revenue,
                               count(distinct account_id) as active_subscriptions,
                               count(distinct case when ends_here then account_id end)
                                   as churned_subscriptions
                        from revenue group by account_id, product_id, tier_id, financial_month''',
                     {
                         "recent": "select * from keyed_subscriptions "
                         "where start_date >= date '2000-01-01'",
                         **_financial_relations(source="recent"),
                     },
                 )
             }))
        select * from new_rows union all
        select * from old_rows
        where financial_month not in (select financial_month from new_rows)""",
    # A full run and an incremental one leave what one full run leaves.
    "incremental_product_usage": _with(
        USAGE_DAY.format(who="account_id", events="usage_events")
    ),
    "incremental_financials": _fact("shared_revenue"),
    "detected_object_counts": _with(OBJECT_DAY.format(source="object_counts_daily")),
    "detected_product_usage": _with(
        USAGE_DAY.format(who="account_id", events="usage_events")
    ),
    "detected_financials": _fact("shared_revenue"),
    "dq_unique": _checks(UNIQUE),
    "dq_not_null": _checks(NOT_NULL),
    "dq_not_null_where": _checks(NOT_NULL_WHERE),
    "dq_relationships": _checks(RELATIONSHIPS),
    "dq_expression_is_true": _checks(EXPRESSION),
    "dq_report": _checks(UNIQUE, NOT_NULL, NOT_NULL_WHERE, RELATIONSHIPS, EXPRESSION),
}
