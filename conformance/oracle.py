"""DuckDB SQL for every registered query.

Written row by row (windows over single lines, orders and sessions) where the
library aggregates, so that agreement of the two tests the library's
rewritings. ``oracle_sql`` composes a query from the named relations it needs.
"""

from __future__ import annotations

import re
from datetime import date

from tidemark.schema import CATEGORIES

# --- the driver's tables as shop tables (see FIXTURES.md) ---------------------

ADAPTER = {
    "r_orders": """
        select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
               case when o_orderstatus = 'O' then 'Returned'
                    when o_orderstatus = 'P' and o_orderpriority in ('4-NOT SPECIFIED', '5-LOW') then 'Cancelled'
                    else 'Completed' end as status,
               case when o_orderstatus = 'O' then cast(o_orderdate as date) + cast(3 + o_orderkey % 28 as int)
                    else cast(o_orderdate as date) end as status_date
        from orders""",
    "r_customers": """
        select c_custkey as customer_id, registration_date,
               registration_date - cast(365 * (18 + c_custkey % 58) as int) as birth_date,
               case when c_custkey % 2 = 0 then 'Male' else 'Female' end as gender,
               n_name as city, r_name as country
        from customer
        join (select customer_id, min(order_date) as registration_date from r_orders group by customer_id) f
          on c_custkey = f.customer_id
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "r_items": """
        select cast(l_linenumber as bigint) as order_item_id, l_orderkey as order_id, l_partkey as product_id,
               cast(l_quantity as int) as quantity,
               cast(cast(floor(l_extendedprice * 100 * (1 - l_discount) / l_quantity) as decimal(18, 2)) * 0.01
                    as decimal(18, 2)) as price_at_purchase,
               case when status = 'Returned' and l_returnflag in ('R', 'A') then 1 else 0 end as returned
        from lineitem join r_orders on l_orderkey = order_id""",
    "r_products": """
        select p_partkey as product_id,
               case p_partkey % 10 when 0 then 'Automotive' when 1 then 'Beauty' when 2 then 'Books'
                    when 3 then 'Electronics' when 4 then 'Fashion' when 5 then 'Food' when 6 then 'Home'
                    when 7 then 'Pets' when 8 then 'Sports' else 'Toys' end as category,
               p_brand as brand, cast(p_retailprice as decimal(18, 2)) as base_price
        from part""",
    "r_sessions": """
        select event_id as session_id, user_id * 10 + event_id % 10 as customer_id,
               date '2001-08-01'
                 - cast(24 * (datediff('day', cast(ts as date), date '2024-01-31') - 1) + event_id % 24 as int)
                 as session_date,
               case when event_type in ('view', 'click') then 'mobile' else 'desktop' end as device,
               1 + cast(floor(value) as int) % 30 as pages_viewed
        from events""",
}

# --- relations shared by the oracles -----------------------------------------

SHARED = {
    # as of the cut
    "buyers": "select * from r_customers where registration_date < $cut",
    "placed": """
        select * from r_orders
        where order_date < $cut and customer_id in (select customer_id from buyers)""",
    "visits": """
        select * from r_sessions
        where session_date < $cut and customer_id in (select customer_id from buyers)""",
    "headers": """
        select order_id, customer_id, order_date,
               if(status_date >= $cut, 'Completed', status) as status,
               if(status_date >= $cut, order_date, status_date) as status_date
        from placed""",
    "lines": """
        select i.order_item_id, i.product_id, i.quantity, i.price_at_purchase, i.order_id,
               if(p.status_date > $cut, 0, i.returned) as returned
        from r_items i join placed p on p.order_id = i.order_id""",
    "priced": """
        select h.customer_id, h.order_id, h.order_date, h.status, h.status_date,
               l.product_id, l.quantity, l.price_at_purchase, l.returned,
               l.price_at_purchase * l.quantity as amount
        from headers h join lines l on l.order_id = h.order_id""",
    "good": """
        select * from headers
        where status = 'Completed'
           or (status = 'Returned' and order_id in (select order_id from lines where returned = 0))""",
    "good_priced": "select p.* from priced p where p.order_id in (select order_id from good)",
    "last_good": """
        select * from good
        qualify row_number() over (partition by customer_id
                                   order by order_date desc nulls last, order_id desc) = 1""",
    "full_returns": """
        select customer_id, order_id, status_date, sum(amount) as total from priced
        where status = 'Returned'
        group by all having count(*) filter (where returned = 0) = 0""",
    "last_full_return": """
        select * from full_returns
        qualify row_number() over (partition by customer_id
                                   order by status_date desc nulls last, order_id desc) = 1""",
    "last_cancel": """
        select * from headers where status = 'Cancelled'
        qualify row_number() over (partition by customer_id
                                   order by status_date desc nulls last, order_id desc) = 1""",
    "newest3": """
        select customer_id, order_id, order_date, status,
               row_number() over (partition by customer_id
                                  order by order_date desc nulls last, order_id desc) as rn
        from headers qualify rn <= 3""",
    "newest3_good": """
        select customer_id, order_id, order_date, status,
               row_number() over (partition by customer_id
                                  order by order_date desc nulls last, order_id desc) as rn
        from good qualify rn <= 3""",
    "active_visits": "select * from visits where session_date between $cut - 180 and $cut",
    # raw, for the label
    "t_orders": "select * from r_orders where customer_id in (select customer_id from buyers)",
    "t_items": "select * from r_items where order_id in (select order_id from t_orders)",
    "t_visits": "select * from r_sessions where customer_id in (select customer_id from buyers)",
    "t_good": """
        select order_id, customer_id, order_date, status from t_orders
        where status = 'Completed'
           or (status = 'Returned' and order_id in (select order_id from t_items where returned = 0))""",
    "t_kept": """
        select g.customer_id, g.order_id, g.order_date,
               cast(coalesce(sum(i.price_at_purchase * i.quantity) filter (where i.returned = 0), 0) as double)
                 as order_total
        from t_good g join t_items i on i.order_id = g.order_id
        group by all""",
    "t_last": """
        select customer_id, order_id, order_date as last_suc_date from t_good
        qualify row_number() over (partition by customer_id
                                   order by order_date desc nulls last, order_id desc) = 1""",
    "t_earlier": """
        select g.customer_id, g.order_id, g.order_date
        from t_good g join t_last l on l.customer_id = g.customer_id
        where (g.order_date = l.last_suc_date) is not true""",
    "t_gaps": """
        select customer_id,
               datediff('day', lag(order_date) over (partition by customer_id order by order_date nulls first), order_date)
                 as interval_days
        from t_good""",
    "t_visit_gaps": """
        select customer_id,
               datediff('day', lag(session_date) over (partition by customer_id order by session_date nulls first), session_date)
                 as interval_days
        from t_visits""",
}


def _frequency(period: str, suffix: str) -> tuple[str, str, str]:
    """(lines, intervals, frequency) of successful orders in a period."""
    lines = f"select order_id, customer_id, order_date from good_priced where order_date {period} $cut - 90"
    gaps = f"""
        select customer_id,
               cast(datediff('day', lag(order_date) over (partition by customer_id order by order_date nulls first), order_date)
                    as int) as interval_days
        from ({lines})"""
    frequency = f"""
        select customer_id, cast(sum(interval_days) as double) / nullif(count(interval_days), 0) as avg_interval{suffix}
        from ({gaps}) group by customer_id"""
    return lines, gaps, frequency


def _all_orders(period: str, suffix: str) -> str:
    return f"""
        select customer_id, count(distinct order_id) as orders_count{suffix},
               cast(sum(amount) as double) as total_orders_value{suffix},
               cast(sum(quantity) as bigint) as total_items_per_customer{suffix}
        from priced where order_date {period} $cut - 90 group by customer_id"""


def _good_orders(period: str, suffix: str) -> str:
    return f"""
        select customer_id,
               cast(sum(total) as double) / count(*) as avg_order_value{suffix},
               cast(min(total) as double) as min_order_value{suffix},
               cast(sum(total) as double) as total_succ_orders_value{suffix},
               count(*) as succ_orders_count{suffix},
               cast(sum(items) as double) / count(*) as avg_items_per_order{suffix},
               cast(sum(items) as bigint) as total_succ_items_per_customer{suffix}
        from (select customer_id, order_id,
                     coalesce(sum(amount) filter (where returned = 0), 0) as total,
                     coalesce(sum(quantity) filter (where returned = 0), 0) as items
              from good_priced where order_date {period} $cut - 90
              group by all)
        group by customer_id"""


def _lost(period: str, suffix: str) -> str:
    names = {
        "count": ("count(distinct order_id)", "count(*)"),
        "values": ("sum(amount)", "sum(total)"),
        "items": ("sum(quantity)", "sum(items)"),
    }
    everything = ", ".join(f"{a} as all_{n}" for n, (a, _) in names.items())
    kept = ", ".join(f"{b} as kept_{n}" for n, (_, b) in names.items())
    kind = {"count": "bigint", "values": "double", "items": "bigint"}
    out = ", ".join(
        f"cast(all_{n} - kept_{n} as {kind[n]}) as return_cancel_orders_{n}{suffix}" for n in names
    )
    return f"""
        select customer_id, {out}
        from (select customer_id, {everything} from priced
              where order_date {period} $cut - 90 group by customer_id)
        join (select customer_id, {kept}
              from (select customer_id, order_id,
                           coalesce(sum(amount) filter (where returned = 0), 0) as total,
                           coalesce(sum(quantity) filter (where returned = 0), 0) as items
                    from good_priced where order_date {period} $cut - 90 group by all)
              group by customer_id) using (customer_id)"""


def _categories(flag: int, statuses: str, items: str, total: str) -> str:
    columns = []
    for category in CATEGORIES:
        for name, value, kind in ((items, "quantity", "bigint"), (total, "amount", "double")):
            condition = f"where category = '{category}' and returned = {flag}"
            columns.append(
                f"cast(coalesce(sum({value}) filter ({condition}), 0) as {kind}) as {category.lower()}_{name}"
            )
    joined = ",\n               ".join(columns)
    return f"""
        select customer_id,
               {joined}
        from priced join r_products using (product_id)
        where status in ({statuses}) group by customer_id"""


def _median(gaps: str, name: str) -> str:
    return f"""
        select customer_id, cast(quantile_disc(interval_days, 0.5) as int) as {name}
        from {gaps} where interval_days is not null group by customer_id"""


def _ranked(gaps: str) -> str:
    return f"""
        select customer_id, cast(interval_days as int) as interval_days,
               row_number() over (partition by customer_id order by interval_days) as rn,
               count(*) over (partition by customer_id) as cnt
        from {gaps} where interval_days is not null"""


def _count_since(days: int) -> str:
    return f"""
        select customer_id, count(*) as successful_orders_{days} from t_good
        where order_date between $last - {days} and $last group by customer_id"""


_HIST_LINES, _HIST_GAPS, _HIST_FREQUENCY = _frequency("<", "")
_90D_LINES, _90D_GAPS, _90D_FREQUENCY = _frequency(">=", "_90d")

QUERIES = {
    # as-of views
    "f_customers_filtered": "select * from buyers",
    "f_orders_filtered": "select order_id, customer_id, order_date, status, status_date from placed",
    "f_sessions_filtered": "select session_id, customer_id, session_date, device, pages_viewed from visits",
    "f_order_level": "select * from headers",
    "f_item_level": "select * replace (cast(price_at_purchase as double) as price_at_purchase) from lines",
    # purchase history and last 90 days
    "f_succ_orders_hist": _HIST_LINES,
    "f_intervals": _HIST_GAPS,
    "f_order_frequency": _HIST_FREQUENCY,
    "f_order_values": _all_orders("<", ""),
    "f_succ_order_values": _good_orders("<", ""),
    "f_return_cancel": _lost("<", ""),
    "f_succ_orders_90d": _90D_LINES,
    "f_intervals_90d": _90D_GAPS,
    "f_order_frequency_90d": _90D_FREQUENCY,
    "f_order_values_90d": _all_orders(">=", "_90d"),
    "f_succ_order_values_90d": _good_orders(">=", "_90d"),
    "f_return_cancel_90d": _lost(">=", "_90d"),
    "f_account_age": """
        select customer_id, cast(datediff('day', registration_date, $cut) as int) as account_age_days from buyers""",
    # last events
    "f_last_successful_order": """
        select customer_id, order_id, cast(datediff('day', order_date, $cut) as int) as last_successful_date
        from last_good""",
    "f_last_successful_stats": """
        select g.customer_id,
               cast(sum(datediff('day', g.order_date, $cut)) as bigint) as last_suc_order_interval,
               cast(coalesce(sum(p.amount) filter (where p.returned = 0), 0) as double) as last_succ_kept_order_total,
               cast(coalesce(sum(p.quantity) filter (where p.returned = 0), 0) as bigint) as last_succ_kept_order_items,
               cast(sum(p.quantity) as bigint) as last_succ_order_items,
               cast(sum(p.amount) as double) as last_succ_order_total
        from last_good g join priced p on p.order_id = g.order_id group by g.customer_id""",
    "f_full_return_orders": """
        select order_id, customer_id, status_date, cast(total as double) as full_return_total from full_returns""",
    "f_last_return_date": """
        select customer_id, order_id, status_date as return_date from last_full_return""",
    "f_last_return_order": """
        select customer_id, order_id, cast(datediff('day', status_date, $cut) as int) as days_from_last_return,
               cast(total as double) as full_return_total
        from last_full_return""",
    "f_last_return_stats": """
        select r.customer_id,
               cast(sum(datediff('day', r.status_date, $cut)) as bigint) as days_from_last_return,
               cast(coalesce(sum(p.amount) filter (where p.returned = 1), 0) as double) as last_return_total,
               cast(coalesce(sum(p.quantity) filter (where p.returned = 1), 0) as bigint) as last_returned_items
        from last_full_return r join priced p on p.order_id = r.order_id group by r.customer_id""",
    "f_last_cancel_order": """
        select customer_id, order_id, cast(datediff('day', status_date, $cut) as int) as days_from_last_cancel
        from last_cancel""",
    "f_last_cancel_stats": """
        select c.customer_id,
               cast(sum(datediff('day', c.status_date, $cut)) as bigint) as days_from_last_cancel,
               cast(sum(p.quantity) as bigint) as last_cancel_items,
               cast(sum(p.amount) as double) as last_cancel_total
        from last_cancel c join priced p on p.order_id = c.order_id group by c.customer_id""",
    # last three orders
    "f_last3_orders": "select customer_id, order_id, order_date, status, cast(rn as int) as rn from newest3",
    "f_last3_succ_orders": "select customer_id, order_id, order_date, status, cast(rn as int) as rn from newest3_good",
    "f_last3_succ_help": """
        select customer_id, order_id, last3_succ_kept_total, last3_succ_kept_items, total_value, total_items,
               cast(datediff('day', lag(order_date) over (partition by customer_id order by order_date nulls first, order_id),
                             order_date) as int) as interval_days
        from (select n.customer_id, n.order_id, n.order_date,
                     cast(coalesce(sum(p.amount) filter (where p.returned = 0), 0) as double) as last3_succ_kept_total,
                     cast(coalesce(sum(p.quantity) filter (where p.returned = 0), 0) as bigint)
                       as last3_succ_kept_items,
                     cast(sum(p.amount) as double) as total_value,
                     cast(sum(p.quantity) as bigint) as total_items
              from newest3_good n join priced p on p.order_id = n.order_id
              group by n.customer_id, n.order_id, n.order_date)""",
    "f_last3_succ_stats": """
        with dated as (
          select customer_id, order_id, any_value(order_date) as order_date
          from priced where order_id in (select order_id from newest3_good) group by all),
        gaps as (
          select customer_id,
                 datediff('day', lag(order_date) over (partition by customer_id order by order_date nulls first, order_id),
                          order_date) as gap
          from dated),
        mean as (
          select customer_id, cast(sum(gap) as double) / nullif(count(gap), 0) as avg_last3_succ_interval
          from gaps group by customer_id),
        sums as (
          select customer_id,
                 cast(coalesce(sum(quantity) filter (where returned = 0), 0) as bigint)
                   as last3_succ_orders_kept_items_total,
                 cast(coalesce(sum(amount) filter (where returned = 0), 0) as double) as last3_succ_orders_kept_total,
                 cast(sum(amount) as double) as last3_succ_orders_total,
                 cast(sum(quantity) as bigint) as last3_succ_orders_items
          from priced where order_id in (select order_id from newest3_good) group by customer_id)
        select * from mean join sums using (customer_id)""",
    "f_last3_orders_help": """
        with marked as (
          select *, coalesce(status = 'Cancelled' or (status = 'Returned' and returned = 1), false) as is_lost
          from priced where order_id in (select order_id from newest3))
        select customer_id,
               cast(coalesce(sum(amount) filter (where is_lost), 0) as double) as return_cancel_order_total,
               cast(sum(amount) as double) as last_3orders_total,
               cast(coalesce(sum(quantity) filter (where is_lost), 0) as bigint) as return_cancel_order_items,
               cast(sum(quantity) as bigint) as last_3orders_items
        from marked group by customer_id""",
    "f_last3_orders_stats": """
        with marked as (
          select *, coalesce(status = 'Cancelled' or (status = 'Returned' and returned = 1), false) as is_lost
          from priced where order_id in (select order_id from newest3))
        select customer_id,
               cast(coalesce(sum(amount) filter (where is_lost), 0) as double) as last3_return_cancel_order_total,
               cast(coalesce(sum(amount) filter (where not is_lost), 0) as double) as last3_kept_total,
               cast(coalesce(sum(quantity) filter (where is_lost), 0) as bigint) as last3_cancels_returns_items,
               cast(coalesce(sum(quantity) filter (where not is_lost), 0) as bigint) as last3_kept_items
        from marked group by customer_id""",
    # categories
    "f_category_counts": _categories(0, "'Completed', 'Returned'", "items", "spent"),
    "f_category_returns": _categories(1, "'Returned'", "items_returned", "returned_total"),
    "f_discount_stats": """
        select customer_id, count(*) filter (where price_at_purchase < base_price) as discounted_items_total
        from priced join r_products using (product_id)
        where status in ('Completed', 'Returned') group by customer_id""",
    # sessions
    "f_last_session": """
        select customer_id, max(session_date) as session_date from active_visits group by customer_id""",
    "f_last_session_stats": """
        select customer_id, cast(datediff('day', session_date, $cut) as int) as days_from_last_session,
               pages_viewed as last_session_pages_viewed
        from active_visits
        qualify session_date = max(session_date) over (partition by customer_id)""",
    "f_successful_orders_180": """
        select customer_id, count(*) as successful_orders_180 from good
        where order_date between $cut - 180 and $cut group by customer_id""",
    "f_sessions_180_stats": """
        select customer_id, count(*) as total_180days_sessions,
               cast(sum(pages_viewed) as double) / count(pages_viewed) as avg_pages_viewed_180,
               min(pages_viewed) as min_pages_viewed_180,
               count(*) filter (where device = 'mobile') as mobile_sessions_count_180,
               count(*) filter (where device = 'desktop') as desktop_sessions_count_180
        from active_visits group by customer_id""",
    "f_sessions_orders_ratio": """
        select customer_id, cast(orders as double) / sessions as sessions_to_succ_orders_180days
        from (select customer_id, count(*) as orders from good
              where order_date between $cut - 180 and $cut group by customer_id)
        join (select customer_id, count(*) as sessions from active_visits group by customer_id)
          using (customer_id)""",
    "f_recent_sessions_90": """
        select customer_id, count(*) as sessions_90d,
               cast(sum(pages_viewed) as double) / count(pages_viewed) as avg_pages_90d
        from visits where session_date between $cut - 90 and $cut group by customer_id""",
    "f_session_intervals": """
        select customer_id, cast(sum(gap) as double) / count(gap) as avg_session_interval
        from (select customer_id,
                     datediff('day', lag(session_date) over (partition by customer_id order by session_date nulls first),
                              session_date) as gap
              from visits)
        where gap is not null group by customer_id""",
    # label
    "t_customers_filtered": "select * from buyers",
    "t_orders_filtered": "select order_id, customer_id, order_date, status, status_date from t_orders",
    "t_items_filtered": "select * replace (cast(price_at_purchase as double) as price_at_purchase) from t_items",
    "t_sessions_filtered": "select session_id, customer_id, session_date, device, pages_viewed from t_visits",
    "t_successful_orders": "select * from t_good",
    "t_successful_orders_30": _count_since(30),
    "t_successful_orders_60": _count_since(60),
    "t_successful_orders_120": _count_since(120),
    "t_orders_30_60": """
        select customer_id, order_id, order_total from t_kept
        where order_date between $last - 60 and $last - 30""",
    "t_sum_orders_30_60": """
        select g.customer_id,
               cast(coalesce(sum(i.price_at_purchase * i.quantity) filter (where i.returned = 0), 0) as double)
                 as total_30_60
        from t_good g join t_items i on i.order_id = g.order_id
        where g.order_date between $last - 60 and $last - 30 group by g.customer_id""",
    "t_last_successful_order": "select * from t_last",
    "t_last_order_total": """
        select k.customer_id, k.order_total as last_suc_order_total
        from t_kept k where k.order_id in (select order_id from t_last)""",
    "t_orders_excl_last": "select * from t_earlier",
    "t_avg_value_excl_last": """
        select customer_id, cast(sum(total) as double) / count(*) as avg_order_value
        from (select e.customer_id, e.order_id,
                     coalesce(sum(i.price_at_purchase * i.quantity) filter (where i.returned = 0), 0) as total
              from t_earlier e join t_items i on i.order_id = e.order_id group by all)
        group by customer_id""",
    "t_order_intervals": "select customer_id, cast(interval_days as int) as interval_days from t_gaps",
    "t_clean_intervals": """
        select customer_id, cast(interval_days as int) as interval_days from t_gaps where interval_days is not null""",
    "t_ranked_intervals": _ranked("t_gaps"),
    "t_median_interval": _median("t_gaps", "median_interval"),
    "t_session_intervals": "select customer_id, cast(interval_days as int) as interval_days from t_visit_gaps",
    "t_clean_session_intervals": """
        select customer_id, cast(interval_days as int) as interval_days
        from t_visit_gaps where interval_days is not null""",
    "t_ranked_session_intervals": _ranked("t_visit_gaps"),
    "t_median_session_interval": _median("t_visit_gaps", "median_session_interval"),
    "t_pages_last_60": """
        select customer_id, cast(sum(pages_viewed) as bigint) as pages_last_60 from t_visits
        where session_date between $last - 60 and $last group by customer_id""",
    "t_last_session": "select customer_id, max(session_date) as last_session_date from t_visits group by customer_id",
    "t_days_since_session": """
        select customer_id, cast(datediff('day', max(session_date), $last) as int) as days_since_last_session
        from t_visits group by customer_id""",
    "t_days_since_successful": """
        select customer_id, cast(datediff('day', last_suc_date, $last) as int) as days_since_last_successful_order
        from t_last""",
    # sources and sinks
    "s_csv_roundtrip": "select * replace (cast(price_at_purchase as double) as price_at_purchase) from r_items",
    "s_lowercase_columns": "select * replace (cast(base_price as double) as base_price) from r_products",
    "s_append_table": """
        select * replace (cast(price_at_purchase as double) as price_at_purchase) from r_items
        union all
        select * replace (cast(price_at_purchase as double) as price_at_purchase) from r_items""",
    "s_parameter_query": """
        select status, count(*) as n_orders, count(distinct customer_id) as n_customers
        from r_orders where order_date >= $cut and order_date < $last group by status""",
}

# The relations joined by the two results, by the names of their queries.
_MATRIX_PARTS = [
    "f_account_age",
    "f_order_frequency",
    "f_succ_order_values",
    "f_return_cancel",
    "f_order_frequency_90d",
    "f_succ_order_values_90d",
    "f_return_cancel_90d",
    "f_last_successful_stats",
    "f_last_return_stats",
    "f_last_cancel_stats",
    "f_last3_orders_stats",
    "f_last3_succ_stats",
    "f_category_counts",
    "f_category_returns",
    "f_discount_stats",
    "f_sessions_180_stats",
    "f_sessions_orders_ratio",
    "f_recent_sessions_90",
    "f_last_session_stats",
    "f_session_intervals",
]


def _feature_matrix() -> str:
    inner = ",\n".join(f"m_{name} as ({QUERIES[name]})" for name in _MATRIX_PARTS)
    joins = "\n".join(f"left join m_{name} using (customer_id)" for name in _MATRIX_PARTS)
    dropped = [
        "registration_date",
        "avg_interval",
        "avg_interval_90d",
        "total_succ_orders_value",
        "total_succ_orders_value_90d",
    ]
    return f"""
        with {inner}
        select * exclude ({", ".join(dropped)}),
               1 / nullif(avg_interval, 0) as shopping_frequency,
               1 / nullif(avg_interval_90d, 0) as shopping_frequency_90d,
               return_cancel_orders_count as unsuccessful_orders_count,
               return_cancel_orders_count_90d as unsuccessful_orders_count_90d
        from buyers {joins}"""


def _target() -> str:
    parts = [name for name in QUERIES if name.startswith("t_successful_orders_")] + [
        "t_sum_orders_30_60",
        "t_pages_last_60",
        "t_median_interval",
        "t_last_order_total",
        "t_avg_value_excl_last",
        "t_median_session_interval",
        "t_days_since_successful",
        "t_days_since_session",
    ]
    inner = ",\n".join(f"m_{name} as ({QUERIES[name]})" for name in parts)
    joins = "\n".join(f"left join m_{name} using (customer_id)" for name in parts)
    return f"""
        with {inner},
        signals as (
          select customer_id, ifnull(successful_orders_30, 0) as n30, ifnull(successful_orders_60, 0) as n60,
                 ifnull(successful_orders_120, 0) as n120, ifnull(pages_last_60, 0) as pages,
                 ifnull(total_30_60, 0) as spent, 5 * avg_order_value as large, last_suc_order_total as newest,
                 median_interval as rhythm, median_session_interval as visit_rhythm,
                 days_since_last_successful_order as idle, days_since_last_session as unseen
          from buyers {joins})
        select customer_id,
               case when n120 = 0 and pages < 3 and rhythm < 120 and newest < large then 'CHURNED'
                    when n30 > 0 then 'ACTIVE'
                    when n60 > 0 and (spent >= large or pages >= 3) then 'ACTIVE'
                    when idle <= rhythm and unseen <= visit_rhythm then 'ACTIVE'
                    else 'AT-RISK' end as target
        from signals"""


QUERIES["feature_matrix"] = _feature_matrix()
QUERIES["target"] = _target()
QUERIES["s_feature_sink"] = QUERIES["feature_matrix"]
QUERIES["s_target_sink"] = QUERIES["target"]


def _needed(text: str, relations: dict[str, str]) -> list[str]:
    """Names of the relations a text uses, directly or not, in definition order."""
    found, todo = set(), [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in relations.keys() & words - found:
            found.add(name)
            todo.append(relations[name])
    return [name for name in relations if name in found]


def oracle_sql(cut: date, last: date, adapter: bool = True) -> dict[str, str]:
    """SQL by query name; without ``adapter`` over existing ``r_*`` tables."""
    relations = (ADAPTER if adapter else {}) | SHARED
    texts = {}
    for name, body in QUERIES.items():
        used = [f"{n} as ({relations[n]})" for n in _needed(body, relations)]
        head = "with " + ",\n".join(used) if used else ""
        text = f"{head}\nselect * from ({body}) result"
        texts[name] = text.replace("$cut", f"date '{cut}'").replace("$last", f"date '{last}'")
    return texts
