"""Oracle SQL (DuckDB) for the registered queries.

The statements are formulated differently from the Spark operators: states over the days come from
window functions over all snapshots at once (gaps and islands), not from applying day after day.
"""

from __future__ import annotations

SNAPSHOTS = """
with base as (
  select c_custkey as customer_id, c_name as full_name,
    date '1970-01-01' + cast(c_custkey % 10000 as int) as date_of_birth,
    case when c_custkey % 29 = 0 then null else concat('N', cast(c_nationkey as varchar)) end as hometown,
    concat('09', lpad(cast(c_custkey as varchar), 8, '0')) as phone_number,
    case when c_custkey % 31 = 0 then null
         else concat('c', cast(c_custkey as varchar), '@', lower(c_mktsegment), '.example.org') end as email,
    case when c_custkey % 3 = 0 then 'Nam' when c_custkey % 3 = 1 then 'Nu' else 'Khac' end as gender
  from customer),
d1 as (select * from base where customer_id % 10 <> 9),
d2 as (
  select customer_id, full_name,
    case when customer_id % 7 = 4 then date_of_birth + 1 else date_of_birth end as date_of_birth,
    case when customer_id % 7 in (1, 3) then 'MOVED'
         when customer_id % 58 = 0 then 'FILLED' else hometown end as hometown,
    case when customer_id % 7 in (2, 3) then concat('08', substr(phone_number, 3)) else phone_number end as phone_number,
    email, case when customer_id % 7 = 1 then 'Khac' else gender end as gender
  from base where not (customer_id % 11 = 4 and customer_id % 10 <> 9)),
d3 as (
  select * from d1 where customer_id % 14 = 1 or customer_id % 22 = 4
  union all
  select * from d2 where customer_id % 14 <> 1 and customer_id % 22 <> 4)
"""

_ATTRS = "full_name, date_of_birth, hometown, phone_number, email, gender"
_ALL = f"customer_id, {_ATTRS}"

# All snapshots in one relation, each row with the key's previous snapshot row.
_SEEN = f"""{SNAPSHOTS},
x as (select *, 1 n, date '2025-11-30' d from d1 union all
      select *, 2, date '2025-12-01' from d2 union all
      select *, 3, date '2025-12-02' from d3),
y as (select *, lag(n) over w pn, lag(d) over w pd,
        lag(row({_ATTRS})) over w prv, row({_ATTRS}) cu,
        row_number() over (partition by customer_id order by n desc) latest
      from x window w as (partition by customer_id order by n))"""

_SCD2 = f"""{_SEEN},
z as (select *, sum(case when pn = n - 1 and prv is not distinct from cu then 0 else 1 end)
        over (partition by customer_id order by n) g from y),
v as (select {_ALL}, min(d) start_date,
        case max(n) when 3 then date '2099-12-31' when 2 then date '2025-12-02' else date '2025-12-01' end end_date
      from z where n <= {{last}} group by {_ALL}, g)
select {_ALL}, start_date, end_date,
  case when end_date = date '2099-12-31' then start_date else end_date end etl_date from v"""
_SCD2_ALL = _SCD2.format(last=3)
_SCD2_DAY2 = _SCD2.format(last=2).replace("when 3 then date '2099-12-31' when 2 then date '2025-12-02'", "when 2 then date '2099-12-31'")

# Versions without regard to gaps: a key that is away keeps its row.
_KEPT = f"""{_SEEN},
z as (select *, sum(case when pn is not null and prv is not distinct from cu then 0 else 1 end)
        over (partition by customer_id order by n) g from y),
v as (select {_ALL}, g, min(d) start_date from z group by {_ALL}, g)"""

_SCD1 = f"{_SEEN} select {_ALL}, date '2025-12-02' etl_date from y where latest = 1"

_SCD4_CURRENT = f"""{_KEPT}
select {_ALL}, start_date as etl_date from v qualify row_number() over (partition by customer_id order by g desc) = 1"""

_SCD4_HISTORY = f"""{_KEPT},
h as (select *, lead(start_date) over (partition by customer_id order by g) end_date from v)
select {_ALL}, start_date, end_date from h where end_date is not null"""

_SCD3 = f"""{_SEEN},
p as (select customer_id,
        arg_max({{{{'v': prv_home}}}}, n) filter (where pn is not null and prv_home is distinct from hometown) home,
        arg_max({{{{'v': prv_phone}}}}, n) filter (where pn is not null and prv_phone is distinct from phone_number) phone
      from (select *, lag(hometown) over w prv_home, lag(phone_number) over w prv_phone
            from y window w as (partition by customer_id order by n)) group by customer_id)
select customer_id, full_name, date_of_birth, hometown, home.v as pre_hometown, phone_number,
  phone.v as pre_phone_number, email, gender, date '2025-12-02' as etl_date
from y join p using (customer_id) where latest = 1""".replace("{{", "{").replace("}}", "}")

# Per day and key: last known values and whether the key is there.
_ACTIVITY = f"""{SNAPSHOTS},
k as (select customer_id from d1 union select customer_id from d2 union select customer_id from d3),
s1 as (select customer_id, row({_ATTRS}) v from d1),
s2 as (select k.customer_id, coalesce(b.v, s1.v) v, b.v is not null a
       from k left join s1 using (customer_id)
       left join (select customer_id, row({_ATTRS}) v from d2) b using (customer_id)),
s as (select s2.customer_id, s1.v v1, s2.v v2, s2.a a2, coalesce(c.v, s2.v) v3, c.v is not null a3
      from s2 left join s1 using (customer_id)
      left join (select customer_id, row({_ATTRS}) v from d3) c using (customer_id)),
state as (select customer_id, case when a3 then '1' else '0' end is_active,
    case when v3 is distinct from v2 or a3 <> a2 then date '2025-12-02'
         when v2 is distinct from v1 or not a2 then date '2025-12-01'
         else date '2025-11-30' end etl_date from s),
last as (select customer_id, {_ATTRS} from d3
  union all select customer_id, {_ATTRS} from d2 where customer_id not in (select customer_id from d3)
  union all select customer_id, {_ATTRS} from d1
    where customer_id not in (select customer_id from d3) and customer_id not in (select customer_id from d2))"""

_SOFT_DELETE = f"{_ACTIVITY} select {_ALL}, is_active, etl_date from last join state using (customer_id)"

_CONFORMED = """customer_id, full_name as customer_name, date_of_birth as customer_birth, hometown as customer_hometown,
  phone_number as customer_phone_num, email as customer_email,
  split_part(split_part(email, '@', -1), '.', 1) as customer_source, gender as customer_gender"""

_CURATED = f"{_ACTIVITY} select {_CONFORMED}, is_active, etl_date from last join state using (customer_id)"
_MART = f"{_CURATED} where is_active = '1'"

_JOINED = f"""{SNAPSHOTS},
j as (select coalesce(o.customer_id, n.customer_id) customer_id, o.customer_id ok, n.customer_id nk,
        o.full_name o_full_name, o.date_of_birth o_date_of_birth, o.hometown o_hometown,
        o.phone_number o_phone_number, o.email o_email, o.gender o_gender,
        n.full_name, n.date_of_birth, n.hometown, n.phone_number, n.email, n.gender
      from d1 o full join d2 n on o.customer_id = n.customer_id)"""


def _feed(old: str, new: str) -> str:
    return f"""select 'I' op, {_ALL} from {new} where customer_id not in (select customer_id from {old})
  union all select 'D', {_ALL} from {old} where customer_id not in (select customer_id from {new})
  union all select 'U', * from (
    select {_ALL} from {new} where customer_id in (select customer_id from {old})
    except select {_ALL} from {old})"""


_UPSERTS = f"{SNAPSHOTS} select {_ALL} from d2 except select {_ALL} from d1"
_MERGED = f"""{SNAPSHOTS} select {_ALL} from d2
union all select {_ALL} from d1 where customer_id not in (select customer_id from d2)"""

_ATTRIBUTE_CHANGES = f"{_JOINED}" + " union all ".join(
    f"""
select customer_id, '{c}' as attribute, cast(o_{c} as varchar) as old_value, cast({c} as varchar) as new_value
from j where ok is not null and nk is not null and o_{c} is distinct from {c}"""
    for c in ("full_name", "date_of_birth", "hometown", "phone_number", "email", "gender")
)

_REVENUE = """
amounts as (select l_orderkey, sum(cast(l_extendedprice as decimal(18, 2)) * (1 - cast(l_discount as decimal(4, 2)))) revenue
            from lineitem group by l_orderkey),
sales as (select o_orderkey, o_custkey, cast(o_orderdate as date) order_date, coalesce(revenue, 0) revenue
          from orders left join amounts on l_orderkey = o_orderkey)"""

_ORDERS = """
with o1 as (select * from orders where o_orderkey % 10 <> 9),
o2 as (select o_orderkey, o_custkey, case when o_orderkey % 7 = 1 then 'F' else o_orderstatus end o_orderstatus,
         o_totalprice, o_orderdate, case when o_orderkey % 13 = 0 then null else o_orderpriority end o_orderpriority
       from orders where not (o_orderkey % 11 = 4 and o_orderkey % 10 <> 9)),
both_days as (select o_orderkey from o1 intersect select o_orderkey from o2),
changed as (select o_orderkey from (select * from o2 except select * from o1) where o_orderkey in (from both_days))
"""

# Day 2 as it is after the correction.
_CORRECTED = _ORDERS.replace("o2 as (select", "wrong as (select").replace(
    "both_days as",
    """o2 as (select * from o1 where o_orderkey % 2 = 0 union all select * from wrong where o_orderkey % 2 <> 0),
both_days as""",
)

ORACLE_SQL: dict[str, str] = {
    "source_scan": "select c_custkey, c_name, c_mktsegment from customer",
    "snapshot_diff": f"{SNAPSHOTS} {_feed('d1', 'd2')}",
    "diff_counts": f"{SNAPSHOTS} select op, count(*) n from ({_feed('d1', 'd2')}) group by op",
    "upsert_rows": _UPSERTS,
    "changed_rows": f"""{SNAPSHOTS} select *, date '2025-11-30' etl_date from
        (select {_ALL} from d1 except select {_ALL} from d2)""",
    "unchanged_rows": f"{SNAPSHOTS} select {_ALL} from d1 intersect select {_ALL} from d2",
    "new_keys": f"{SNAPSHOTS} select {_ALL} from d2 where customer_id not in (select customer_id from d1)",
    "deleted_rows": f"{SNAPSHOTS} select {_ALL} from d1 where customer_id not in (select customer_id from d2)",
    "attribute_changes": _ATTRIBUTE_CHANGES,
    "scd1": _SCD1,
    "scd2": _SCD2_ALL,
    "scd2_day2": _SCD2_DAY2,
    "scd2_current": f"select * from ({_SCD2_ALL}) where end_date = date '2099-12-31'",
    "scd3": _SCD3,
    "scd4_current": _SCD4_CURRENT,
    "scd4_history": _SCD4_HISTORY,
    "top_dim_rows": f"{_SCD1} order by customer_id limit 10",
    "latest_history": f"{_SCD4_HISTORY} order by start_date desc, customer_id limit 5",
    "scd1_job": _SCD1,
    "scd2_job": _SCD2_ALL,
    "scd3_job": _SCD3,
    "scd4_job_current": _SCD4_CURRENT,
    "scd4_job_history": _SCD4_HISTORY,
    "merge_upsert": _MERGED,
    "merge_soft_delete": _SOFT_DELETE,
    "merge_noop": f"""{_ACTIVITY} select (select count(*) from ({_feed('d1', 'd2')})) n_first, count(*) n
        from s2 full join (select customer_id, row({_ATTRS}) v from d2) t using (customer_id)
        where a is distinct from (t.v is not null) or (a and s2.v is distinct from t.v)""",
    "staged_replace": _MERGED,
    "staged_replace_partitioned": f"""{_ORDERS} select * from o2 where o_orderpriority is distinct from '1-URGENT'
        union all select * from o1 where o_orderpriority = '1-URGENT'""",
    "cdc_feed": f"""{SNAPSHOTS} select *, date '2025-12-01' change_date from ({_feed('d1', 'd2')})
        union all select *, date '2025-12-02' from ({_feed('d2', 'd3')})""",
    "cdc_apply": f"{SNAPSHOTS} select {_ALL} from d3",
    "stg_load": f"{SNAPSHOTS} select {_ALL}, date '2025-12-02' etl_date from d3",
    "prc_conform": f"{SNAPSHOTS} select {_CONFORMED}, '1' is_active, date '2025-12-02' etl_date from d3",
    "cur_load": _CURATED,
    "dmt_customer_dim": _MART,
    "layered_run": _MART,
    "email_org": f"""{SNAPSHOTS} select customer_id, email,
        regexp_extract(email, '@([^@.]*)[.][^@]*$', 1) as customer_source from base""",
    "clean_nulls": f"""{SNAPSHOTS} select customer_id, full_name, date_of_birth,
        case when hometown is null then 'UNKNOWN' else hometown end hometown, phone_number,
        case when email is null then 'none' else email end email, gender from base""",
    "dedup_latest": f"{_SEEN} select {_ALL}, d as etl_date from y where latest = 1",
    "dedup_latest_events": """select * from events e where not exists (
        select 1 from events f where f.user_id = e.user_id
          and (f.ts > e.ts or (f.ts = e.ts and f.event_id > e.event_id)))""",
    "normalise_types": """select c_custkey as customer_id, c_name as full_name,
        case when c_nationkey = 0 then null
             else date '1970-01-01' + cast(c_custkey % 10000 as int) end as date_of_birth,
        case when c_acctbal >= 0 then cast(cast(c_acctbal as decimal(12, 2)) as double) end as balance from customer""",
    "union_parts": """select concat('C', c_custkey) party_id, c_name party_name, c_nationkey nation_id,
          c_mktsegment segment, date '2025-12-01' etl_date from customer
        union all select concat('S', s_suppkey), s_name, s_nationkey, null, date '2025-12-01' from supplier""",
    "cur_customer_metrics": f"""{SNAPSHOTS}, {_REVENUE}
        select customer_id, full_name as customer_name, split_part(split_part(email, '@', -1), '.', 1) as customer_source,
          count(o_orderkey) n_orders, cast(coalesce(sum(revenue), 0) as double) revenue, max(order_date) last_order_date
        from d3 left join sales on o_custkey = customer_id group by 1, 2, 3""",
    "dmt_sales_fact": f"""{SNAPSHOTS}, {_REVENUE}
        select cast(date_trunc('month', order_date) as date) order_month,
          coalesce(split_part(split_part(email, '@', -1), '.', 1), 'UNKNOWN') customer_source,
          coalesce(gender, 'UNKNOWN') gender, count(*) n_orders, cast(sum(revenue) as double) revenue
        from sales left join d3 on o_custkey = customer_id group by 1, 2, 3""",
    "layered_run_full": f"""{SNAPSHOTS},
        party as (select customer_id, coalesce(hometown, 'unknown') hometown from d2
                  union all select -1 - s_suppkey, concat('N', cast(s_nationkey as varchar)) from supplier),
        parties as (select hometown, count(*) n_parties from party group by hometown),
        sales as (select coalesce(hometown, 'UNKNOWN') hometown, count(*) n_orders,
                    cast(sum(cast(o_totalprice as decimal(18, 2))) as double) total
                  from orders left join party on o_custkey = customer_id group by 1)
        select hometown, n_parties, n_orders, total from parties full join sales using (hometown)""",
    "orders_snapshot_diff": f"""{_ORDERS}
        select case when o_orderkey in (select o_orderkey from o1) then 'U' else 'I' end op, *
        from (select * from o2 except select * from o1)
        union all select 'D', * from o1 where o_orderkey not in (select o_orderkey from o2)""",
    "orders_scd1": f"""{_ORDERS} select *, date '2025-12-01' etl_date from
        (from o2 union all from o1 where o_orderkey not in (select o_orderkey from o2))""",
    "orders_scd2": f"""{_ORDERS}
        select *, date '2025-11-30' start_date, date '2099-12-31' end_date, date '2025-11-30' etl_date
        from (from o1 intersect from o2)
        union all select *, date '2025-11-30', date '2025-12-01', date '2025-12-01' from (from o1 except from o2)
        union all select *, date '2025-12-01', date '2099-12-31', date '2025-12-01' from (from o2 except from o1)""",
    "scd2_corrected_day": f"""{_CORRECTED}
        select *, date '2025-11-30' start_date, date '2099-12-31' end_date, date '2025-11-30' etl_date
        from (from o1 intersect from o2)
        union all select *, date '2025-11-30', date '2025-12-01', date '2025-12-01' from (from o1 except from o2)
        union all select *, date '2025-12-01', date '2099-12-31', date '2025-12-01' from (from o2 except from o1)""",
    "scd4_corrected_day": f"""{_CORRECTED}
        select *, date '2025-11-30' start_date, date '2025-12-01' end_date from o1 where o_orderkey in (from changed)""",
    "orders_scd3": f"""{_ORDERS}
        select coalesce(n.o_orderkey, o.o_orderkey) o_orderkey, coalesce(n.o_custkey, o.o_custkey) o_custkey,
          coalesce(n.o_orderstatus, o.o_orderstatus) o_orderstatus,
          case when n.o_orderstatus <> o.o_orderstatus then o.o_orderstatus end pre_orderstatus,
          coalesce(n.o_totalprice, o.o_totalprice) o_totalprice, coalesce(n.o_orderdate, o.o_orderdate) o_orderdate,
          case when n.o_orderkey is null then o.o_orderpriority else n.o_orderpriority end o_orderpriority,
          case when n.o_orderkey is not null and n.o_orderpriority is null then o.o_orderpriority end pre_orderpriority,
          date '2025-12-01' etl_date
        from o1 o full join o2 n on o.o_orderkey = n.o_orderkey""",
    "orders_scd4_current": f"""{_ORDERS}
        select *, date '2025-11-30' etl_date from o1 where o_orderkey not in (from changed)
        union all select *, date '2025-12-01' from (from o2 except from o1)""",
    "orders_scd4_history": f"""{_ORDERS}
        select *, date '2025-11-30' start_date, date '2025-12-01' end_date from o1 where o_orderkey in (from changed)""",
    "orders_merge_soft_delete": f"""{_ORDERS}
        select *, '1' is_active, date '2025-11-30' etl_date from (from o1 intersect from o2)
        union all select *, '1', date '2025-12-01' from (from o2 except from o1)
        union all select *, '0', date '2025-12-01' from o1 where o_orderkey not in (select o_orderkey from o2)""",
    "merge_touched_parts": f"""{_ORDERS}
        select * from o1 where o_orderkey in (select o_orderkey from o2)
          and o_orderkey not in (select o_orderkey from o2 where o_orderpriority is null and o_orderkey in (from changed))
        union all select * from o2 where o_orderpriority is null and o_orderkey in (from changed)""",
    "fact_asof_versions": f"""with v as ({_SCD2_ALL}),
        f as (select o_orderkey, case when o_orderkey % 97 = 0 then null else o_custkey end customer_id,
                case when o_orderkey % 89 = 0 then null else date '2025-11-30' + cast(o_orderkey % 6 as int) - 2 end sold_on from orders)
        select o_orderkey, f.customer_id, sold_on, hometown, gender
        from f left join v on v.customer_id = f.customer_id and start_date <= sold_on and sold_on < end_date""",
    "layered_run_resumed": f"""{SNAPSHOTS}, o2 as (select * from orders where not (o_orderkey % 11 = 4 and o_orderkey % 10 <> 9))
        select coalesce(hometown, 'UNKNOWN') hometown, count(*) n_orders,
          cast(sum(cast(o_totalprice as decimal(18, 2))) as double) total, 2 n_stg, 2 n_cur, 2 n_dim, 3 n_sales
        from o2 left join d2 on o_custkey = customer_id group by 1""",
    "sales_asof_fact": f"""with v as ({_SCD2_ALL}),
        f as (select o_totalprice, case when o_orderkey % 97 = 0 then null else o_custkey end customer_id,
                case when o_orderkey % 89 = 0 then null else date '2025-11-30' + cast(o_orderkey % 6 as int) - 2 end sold_on from orders)
        select cast(date_trunc('month', sold_on) as date) as month, coalesce(hometown, 'UNKNOWN') hometown, coalesce(gender, 'UNKNOWN') gender,
          count(*) n_orders, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) total
        from f left join v on v.customer_id = f.customer_id and start_date <= sold_on and sold_on < end_date group by 1, 2, 3""",
    "scd2_job_late_day": _SCD2_ALL,
    "cdc_feed_job": f"{_ORDERS} select * from o2",
    "scd2_backfill": _SCD2_ALL,
    "scd2_late_day": _SCD2_ALL,
    "scd2_job_rerun": _SCD2_ALL,
    "cdc_apply_ordered": f"{SNAPSHOTS} select {_ALL} from d3",
    "sales_fact_delta": f"""{_ORDERS} select o_orderstatus status, o_orderpriority priority, count(*) n_facts,
        cast(sum(cast(o_totalprice as decimal(18, 2))) as double) total from o2 group by 1, 2""",
    "diff_by_fingerprint": f"""{_ORDERS}
        select case when o_orderkey in (select o_orderkey from o1) then 'U' else 'I' end op, *
        from (select * from o2 except select * from o1)
        union all select 'D', * from o1 where o_orderkey not in (select o_orderkey from o2)""",
    "normalise_rejects": """with bad as (
          select c_custkey, 'date_of_birth' as column, 'unknown' as text, 'not a value of type date yyyyMMdd' reason
          from customer where c_nationkey = 0
          union all select c_custkey, 'balance', 'n/a', 'not a value of type double' from customer where c_acctbal < 0)
        select concat(' ', cast(c_custkey as varchar), '  ') raw_id, bad.column, text, reason, n_rows, n_accepted, n_rows - n_accepted n_rejected,
          n_accepted n_stored
        from bad, (select count(*) n_rows, count(*) filter (where c_nationkey <> 0 and c_acctbal >= 0) n_accepted from customer)""",
    "source_split": """select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then 7 when l_orderkey % 11 = 0 then null
          else l_orderkey - 50 * l_linenumber end account, count(*) n_branches from lineitem group by 1, 2, 3""",
    "metrics_distinct": """with e as (select *, cast(ts as date) d from events),
        m as (select min(d) + cast(datediff('day', min(d), max(d)) // 2 as int) middle from e)
        select event_type, count(distinct user_id) n_users, true near from e, m where d >= middle group by 1""",
}
