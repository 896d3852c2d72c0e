"""Independent DuckDB oracle SQL, one statement per proof key.

These are *specifications*: the Spark side is written with the library functions, not
with this text. The defect-injection expressions (`% 101`, `% 103`, ...) match
`plans/fixtures.py`; they choose which rows are defective, and every statement reads its
whole tables.
"""

from __future__ import annotations

_RAW = """with raw as (select event_id, ts, value,
  case when event_id % 101 = 0 then null else user_id end as device_id,
  case when event_id % 103 = 0 then null else event_type end as facility_id from events),
 tag as (select *, device_id is not null as ok_dev, facility_id is not null as ok_fac,
  (value is not null and value between 0 and 150) as ok_rng from raw),
 dq as (select *, (ok_dev and ok_fac and ok_rng) as passed,
  case when not ok_dev then 'DQ-001' when not ok_fac then 'DQ-003' when not ok_rng then 'DQ-004' end as reason from tag),
 rk as (select *, row_number() over (partition by device_id, facility_id, cast(ts as date) order by ts desc, event_id desc) as rn from dq where passed) """

_CDC = """with log as (select user_id as k, event_id as lsn, ts, value,
  case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op from events),
 base0 as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log where ts < timestamp '2024-01-01 06:00:00'),
 base as (select k, lsn, ts, value, op = 'DELETE' as is_deleted from base0 where rn = 1),
 inc0 as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log where ts >= timestamp '2024-01-01 06:00:00'),
 inc as (select * from inc0 where rn = 1) """

_SCD = """with src as (select s_suppkey as k, s_name, s_nationkey, case when s_suppkey % 7 = 0 then cast(s_acctbal as decimal(12,2)) + 1 else cast(s_acctbal as decimal(12,2)) end as bal from supplier),
 t1 as (select s_suppkey as k, s_name, s_nationkey, cast(s_acctbal as decimal(12,2)) as bal from supplier where s_suppkey % 10 <> 3),
 s as (select *, sha256(concat_ws('||', coalesce(s_name,'~'), coalesce(cast(s_nationkey as varchar),'~'), coalesce(cast(bal as varchar),'~'))) as h from src),
 t as (select *, sha256(concat_ws('||', coalesce(s_name,'~'), coalesce(cast(s_nationkey as varchar),'~'), coalesce(cast(bal as varchar),'~'))) as h from t1) """

_PARTV = """with d as (select p_partkey, 1 as ver, date '1995-01-01' as st, case when p_partkey % 3 = 0 then date '1998-01-01' end as en from part
  union all select p_partkey, 2, date '1998-01-01', cast(null as date) from part where p_partkey % 3 = 0) """

_STAR = """with eqv as (select cast(p_partkey as varchar) as eid, 1 as ver, date '1900-01-01' as st, case when p_partkey % 3 = 0 then date '2024-01-16' end as en from part
  union all select cast(p_partkey as varchar), 2, date '2024-01-16', cast(null as date) from part where p_partkey % 3 = 0),
 eq as (select *, row_number() over (order by eid, ver) as sk from eqv) """

_MAINT = """, fac as (select fid, row_number() over (order by fid) as sk from (select distinct event_type as fid from events) x),
 m as (select *, case when event_id % 11 = 0 then null else 'T' || cast(user_id % 7 as varchar) end as tid from events),
 tech as (select tid, row_number() over (order by tid) as sk from (select distinct tid from m where tid is not null) x) """

_STATES = _CDC.replace("ts, value,", "ts, value, event_type,") + """, nxt as (select coalesce(b.k, i.k) as k,
  case when i.op in ('INSERT','UPDATE') then i.value else b.value end as value,
  case when i.op in ('INSERT','UPDATE') then i.event_type else b.event_type end as event_type,
  case when i.op = 'DELETE' then true when i.op in ('INSERT','UPDATE') then false else b.is_deleted end as is_deleted
  from base b full outer join inc i on b.k = i.k where b.k is not null or i.op <> 'DELETE') """

ORACLE = {
    # ---- data quality
    "dq_tag": _RAW + "select event_id, ok_dev, ok_fac, ok_rng, passed, reason from dq",
    "dq_valid_dedup": _RAW + "select event_id, device_id, facility_id, cast(ts as date) as event_date, value from rk where rn = 1",
    "dq_quarantine": _RAW + "select sha256(concat_ws('|','events',cast(event_id as varchar),reason)) as violation_id, 'events' as source_table, cast(device_id as varchar) as record_key, reason, 'QUARANTINE' as action_taken from dq where not passed",
    "dq_all_violations": _RAW + "select event_id, reason from dq where not passed union all select event_id, 'DQ-006' as reason from rk where rn > 1",
    "dq_metrics": _RAW + "select (select count(*) from raw) as n_in, (select count(*) from rk where rn=1) as n_valid, (select count(*) from dq where not passed) as n_bad, (select count(*) from rk where rn>1) as n_dup",
    "dq_all_failed_rules": _RAW + "select event_id, concat_ws(',', case when not ok_dev then 'DQ-001' end, case when not ok_fac then 'DQ-003' end, case when not ok_rng then 'DQ-004' end) as failed_rules from dq where not passed",
    "dq_report": _RAW + "select reason, count(*) as n from (select reason from dq where not passed union all select 'DQ-006' as reason from rk where rn > 1) x group by reason",
    "audit_log": _RAW + "select 'events' as target_table, 'WRITE' as action_type, (select count(*) from rk where rn = 1) as n_rows, 'run-1' as run_id",
    "silver_balance": _RAW + """select d as _disposition, count(*) as n from (
  select case when not passed then 'quarantined' end as d from dq where not passed
  union all select case when rn = 1 then 'valid' else 'duplicate' end from rk) x group by d""",
    "dq_cross_column": "select l_orderkey, l_linenumber, l_partkey, (l_quantity >= 0 and cast(l_discount as decimal(5,2)) + cast(l_tax as decimal(5,2)) <= 0.12) as consistent from lineitem",
    "derived_rates": "select o_orderkey, case when cast(floor(o_totalprice) as bigint) % 5 > 0 then o_totalprice / (cast(floor(o_totalprice) as bigint) % 5) end as rate from orders",
    "fk_orphans": "select o_orderkey, 'DQ-010' as violated_rule_id, cast(o_orderkey as varchar) as field_value, 'WARN' as action_taken from orders anti join lineitem on o_orderkey = l_orderkey",
    "union_missing_cols": "select event_id as id, event_type as reason, cast(null as varchar) as field_name from events where value > 300 union all select o_orderkey, 'FK', 'o_orderkey' from orders anti join lineitem on o_orderkey=l_orderkey",
    "bucket_case": "select c_custkey, case c_custkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'C' else 'D' end as fac, case when (c_custkey*37)%100 < 20 then 'HIGH' when (c_custkey*37)%100 < 76 then 'MEDIUM' else 'LOW' end as pri from customer",
    # ---- change data capture
    "cdc_latest": _CDC + "select k, lsn, op, value from inc",
    "cdc_superseded": _CDC + "select k, lsn, 'DQ-MR-002' as reason from inc0 where rn > 1",
    "cdc_merge": _CDC + """select coalesce(b.k, i.k) as k, case when i.op in ('INSERT','UPDATE') then i.value else b.value end as value,
  case when i.op = 'DELETE' then true when i.op in ('INSERT','UPDATE') then false else b.is_deleted end as is_deleted
  from base b full outer join inc i on b.k = i.k where b.k is not null or i.op <> 'DELETE'""",
    "live_view": _CDC + """select coalesce(b.k, i.k) as k, case when i.op in ('INSERT','UPDATE') then i.value else b.value end as value
  from base b full outer join inc i on b.k = i.k
  where (b.k is not null or i.op <> 'DELETE')
    and not (case when i.op = 'DELETE' then true when i.op in ('INSERT','UPDATE') then false else b.is_deleted end)""",
    "cdc_delete_unknown": _CDC + "select count(*) as n from inc i anti join base b on b.k = i.k where i.op='DELETE'",
    "cdc_late_change": """with st0 as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events where event_type in ('view', 'click')),
  st as (select user_id as k, event_id as lsn, ts, value from st0 where rn = 1),
  ch0 as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events where event_type not in ('view', 'click')),
  ch as (select user_id as k, event_id as lsn, ts, value from ch0 where rn = 1)
  select coalesce(st.k, ch.k) as k, case when st.k is null or ch.ts > st.ts or (ch.ts = st.ts and ch.lsn > st.lsn) then ch.value else st.value end as value,
  case when ch.k is null then 'untouched' when st.k is null then 'inserted' when ch.ts > st.ts or (ch.ts = st.ts and ch.lsn > st.lsn) then 'updated' else 'ignored_late' end as outcome
  from st full outer join ch on st.k = ch.k""",
    # the next snapshot must be exactly the full merge
    "cdc_merge_incremental": _CDC + """select coalesce(b.k, i.k) as k, case when i.op in ('INSERT','UPDATE') then i.value else b.value end as value,
  case when i.op = 'DELETE' then true when i.op in ('INSERT','UPDATE') then false else b.is_deleted end as is_deleted
  from base b full outer join inc i on b.k = i.k where b.k is not null or i.op <> 'DELETE'""",
    # one-at-a-time semantics from an empty table: the last change decides deleted or not,
    # the last upsert gives the value; keys that were only ever deleted do not appear
    "cdc_sequential": """with log as (select user_id as k, event_id as lsn, ts, value,
  case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op from events),
  l as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log),
  u as (select k, value, row_number() over (partition by k order by ts desc, lsn desc) as rn from log where op <> 'DELETE')
  select l.k, u.value, l.op = 'DELETE' as is_deleted from l join u on l.k = u.k and u.rn = 1 where l.rn = 1""",
    # two registers per key, whatever the arrival order: the last change decides deleted
    # or not, the last upsert gives the value; keys only ever deleted stay as empty tombstones
    "cdc_out_of_order": """with log as (select user_id as k, event_id as lsn, ts, value,
  case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op from events),
  l as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log),
  u as (select k, value, row_number() over (partition by k order by ts desc, lsn desc) as rn from log where op <> 'DELETE')
  select l.k, u.value, l.op = 'DELETE' as is_deleted from l left join u on l.k = u.k and u.rn = 1 where l.rn = 1""",
    # ---- history
    "scd2_new": _SCD + "select s.k, s.h from s anti join t on s.k = t.k",
    "scd2_changed": _SCD + "select s.k, t.h as old_h, s.h as new_h from s join t on s.k = t.k where s.h is distinct from t.h",
    "scd2_apply": _SCD + """select t.k, t.bal, date '2026-01-01' as start_date, case when s.h is distinct from t.h then date '2026-02-01' end as end_date, s.h is not distinct from t.h as is_current, 1 as version from t join s on s.k = t.k
  union all select s.k, s.bal, date '2026-02-01', cast(null as date), true, case when t.k is null then 1 else 2 end from s left join t on s.k = t.k where t.k is null or s.h is distinct from t.h""",
    "scd2_apply_incremental": _SCD + """select t.k, t.bal, date '2026-01-01' as start_date, case when s.h is distinct from t.h then date '2026-02-01' end as end_date, s.h is not distinct from t.h as is_current, 1 as version from t join s on s.k = t.k
  union all select s.k, s.bal, date '2026-02-01', cast(null as date), true, case when t.k is null then 1 else 2 end from s left join t on s.k = t.k where t.k is null or s.h is distinct from t.h""",
    "scd2_init": "select s_suppkey as k, cast(s_acctbal as decimal(12,2)) as bal, date '1900-01-01' as start_date, cast(null as date) as end_date, true as is_current, 1 as version from supplier",
    # ---- dimensions and facts
    "sk_dense": "select o_orderpriority, cast(row_number() over (order by o_orderpriority) as bigint) as sk from (select distinct o_orderpriority from orders) x",
    "fact_temporal_join": _PARTV + "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, ver from lineitem join d on l_partkey = p_partkey and cast(l_shipdate as date) >= st and (cast(l_shipdate as date) < en or en is null)",
    "fact_star_join": """select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, c_nationkey, cast(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) as int) as date_sk,
  cast(cast(l_extendedprice as decimal(12,2))*(1-cast(l_discount as decimal(4,2))) as decimal(18,4)) as net from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey""",
    "dim_from_fact": "with t as (select distinct case when user_id % 11 = 0 then null else user_id end as technician_id from events) select technician_id, 'Tech_' || cast(technician_id as varchar) as technician_name, 'LEVEL_1' as certification_level, cast(row_number() over (order by technician_id) as bigint) as technician_sk from t where technician_id is not null",
    "dim_order": "select o_orderkey as order_id, o_orderpriority as priority, cast(o_orderdate as date) as planned_start_date, cast(null as date) as planned_end_date, cast(row_number() over (order by o_orderkey) as bigint) as order_sk from orders",
    "dim_versions": _PARTV + "select p_partkey, ver, st, en, en is null as is_current, cast(row_number() over (order by p_partkey, ver) as bigint) as part_sk from d",
    "sk_incremental": """with first as (select distinct o_custkey from orders where o_orderdate < timestamp '1997-01-01 00:00:00'),
  k1 as (select o_custkey, cast(row_number() over (order by o_custkey) as bigint) as sk from first),
  rest as (select distinct o_custkey from orders where o_custkey not in (select o_custkey from first)),
  k2 as (select o_custkey, (select coalesce(max(sk), 0) from k1) + cast(row_number() over (order by o_custkey) as bigint) as sk from rest)
  select o_custkey, sk from k1 union all select o_custkey, sk from k2""",
    "fact_production": """with li as (select l_orderkey, sum(l_quantity) as ordered, sum(case when l_returnflag = 'R' then l_quantity else 0.0 end) as rejected from lineitem group by l_orderkey)
  select o_orderkey, cast(year(o_orderdate)*10000+month(o_orderdate)*100+day(o_orderdate) as int) as date_sk, ordered as units_produced,
  ordered - rejected as units_passed, rejected as defect_count, case when ordered > 0 then (ordered - rejected) / ordered end as yield_rate
  from orders join li on o_orderkey = l_orderkey""",
    "fact_unknown_member": "select o_orderkey, coalesce(d.sk, -1) as sk from orders left join (select p_partkey, cast(p_partkey + 1 as bigint) as sk from part where p_partkey % 2 = 0) d on o_custkey = d.p_partkey",
    "fact_maintenance": "select e.event_id, e.user_id, c.c_nationkey, cast(year(e.ts)*10000+month(e.ts)*100+day(e.ts) as int) as date_sk, e.value from events e join customer c on e.user_id = c.c_custkey where e.event_type <> 'error'",
    "cost_split": "select event_id, cast(cast(value as decimal(12,2)) * ((event_id * 37) % 100) as decimal(20,2)) as parts_x1000, cast(cast(value as decimal(12,2)) * ((event_id * 61) % 100) as decimal(20,2)) as labor_x1000, cast(cast(value as decimal(12,2)) * (((event_id * 37) % 100) + ((event_id * 61) % 100)) as decimal(20,2)) as total_x1000 from events",
    "date_shift": "select o_orderkey, cast(cast(o_orderdate as date) - interval '7' day as date) as d7, o_orderdate + interval '3600' second as t1 from orders",
    # date spine over the whole order-date range of the data (grows with the table)
    "dim_date": """select cast(d as date) as date_day, cast(strftime(d,'%Y%m%d') as int) as timestamp_sk, cast(year(d) as int) as y, cast(quarter(d) as int) as q, cast(month(d) as int) as m, cast(day(d) as int) as dom, (month(d) = 12 and day(d) = 31) as is_year_end, monthname(d) as month_name, strftime(d,'%b') as mon, cast(weekofyear(d) as int) as w, cast(dayofweek(d)+1 as int) as dow, dayname(d) as day_name, dayofweek(d) in (0,6) as is_weekend, cast(d as date)=last_day(d) as is_month_end, concat('FQ',quarter(d)) as fq
  from (select unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day)) as d from orders) x""",
    # ---- governance and checks
    "rls_scoped": "select c_custkey, c_nationkey from customer where c_nationkey in (select n_nationkey from nation join region on n_regionkey=r_regionkey where r_name='EUROPE' or false)",
    "cls_mask": "select c_custkey, concat(left(c_name,5),'***') as c_name, c_acctbal from customer",
    "chk_date_coverage": "select count(*) as n from orders anti join (select distinct cast(l_shipdate as date) as d from lineitem) x on cast(o_orderdate as date)=d",
    "chk_fk_left_null": "select count(*) as n from orders left join lineitem on o_orderkey=l_orderkey where l_orderkey is null",
    "chk_unmasked": "select cast(count_if(not (coalesce(m,'') like '%***')) as bigint) as n from (select concat(left(c_name,5),'***') as m from customer) x",
    "chk_fact_grain": _PARTV + "select l_partkey, count(*) as n_extra from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, count(*) as n from lineitem join d on l_partkey = p_partkey and cast(l_shipdate as date) >= st and (cast(l_shipdate as date) <= en or en is null) group by all) y where n > 1 group by l_partkey",
    "chk_reconcile": "select (select count(*) from orders) as n_src, (select count(*) from orders where o_orderkey % 50 <> 0) as n_dst, (select count(*) from orders a anti join (select * from orders where o_orderkey % 50 <> 0) b on a.o_orderkey = b.o_orderkey) as n_missing, (select count(*) from (select * from orders where o_orderkey % 50 <> 0) b anti join orders a on a.o_orderkey = b.o_orderkey) as n_extra",
    "chk_not_null": """with raw as (select event_id, ts, value,
  case when event_id % 101 = 0 then null else user_id end as device_id,
  case when event_id % 103 = 0 then null else event_type end as facility_id from events) select cast(count_if(device_id is null) as bigint) as device_id, cast(count_if(facility_id is null) as bigint) as facility_id, cast(count_if(ts is null) as bigint) as ts from raw""",
    "chk_rls_scope": "select count(distinct r_regionkey) as n from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name = 'EUROPE'",
    # ---- ingest, streams, layout (the Spark side really writes and re-reads)
    "json_roundtrip": "select event_id, user_id, event_type, value, cast(ts as date) as d from events",
    "csv_roundtrip": "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier",
    "source_file": "select event_id, 'events.parquet' as source_file from events",
    "conform_schema": "select cast(s_suppkey as varchar) as equipment_id, s_name as model_number, cast(s_acctbal as decimal(12,2)) as asset_value, cast(null as date) as effective_end_date from supplier",
    "stream_ingest": "select event_id, user_id, event_type, value from events",
    "stream_rerun": "select count(*) as n from events",
    "layout_same_rows": "select * from lineitem",
    "stream_dq_split": "select event_id, case when value is not null and value between 0 and 150 then 'valid' else 'quarantined' end as _disposition from events",
    "stream_dedup": "select event_id, user_id from events",
    "rescued_fields": "select event_id, props from events",
    "stream_cdc_out_of_order": """with log as (select user_id as k, event_id as lsn, ts, value,
  case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op from events),
  l as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log),
  u as (select k, value, row_number() over (partition by k order by ts desc, lsn desc) as rn from log where op <> 'DELETE')
  select l.k, u.value, l.op = 'DELETE' as is_deleted from l left join u on l.k = u.k and u.rn = 1 where l.rn = 1""",
    "schema_evolution": "select event_id, value from events",
    # first application of the whole log to an empty table: latest change per key,
    # deletes of keys the table never held are ignored
    "stream_cdc_apply": """with log as (select user_id as k, event_id as lsn, ts, value,
  case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as op from events),
  l as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log)
  select k, value, false as is_deleted from l where rn = 1 and op <> 'DELETE'""",
    # ---- rows that show the edge cases: copies, NULL keys, retries, late snapshots
    "dq_exact_copies": _RAW.replace("from events)", "from (select * from events union all select * from events) e)") + """select event_id,
  sum(case when passed and rn = 1 then 1 else 0 end)::bigint as n_valid, sum(case when passed and rn > 1 then 1 else 0 end)::bigint as n_duplicate,
  sum(case when not passed then 1 else 0 end)::bigint as n_quarantined
  from (select event_id, passed, rn from rk union all select event_id, passed, cast(null as bigint) from dq where not passed) x group by event_id""",
    "fk_null_keys": """select count(*) as n_rows, count(*) as n_ids, count(*) filter (user_id is null) as n_null from
  (select case when user_id % 11 = 0 then null else user_id end as user_id from events) e
  where user_id is null or user_id not in (select c_custkey from customer)""",
    "chk_reconcile_dups": "select 2 * count(*) as n_src, count(*) as n_dst, count(*) as n_missing, cast(0 as bigint) as n_extra from orders",
    "cdc_null_keys": """with log as (select case when user_id % 10 = 3 then null else user_id end as k, event_id as lsn, ts, value, event_type from events),
  l as (select *, row_number() over (partition by k order by ts desc, lsn desc) as rn from log)
  select k, value, false as is_deleted from l where rn = 1 and event_type <> 'error'""",
    "scd2_late": _SCD + "select t.k, t.bal, true as is_current, s.h is distinct from t.h as late from t join s on s.k = t.k",
    # every version is there twice: a copy runs into its twin unless it ends where it starts; the last of a
    # key has no successor
    "history_overlaps": _PARTV + """, v as (select p_partkey, case when ver = 2 then 5 else ver end as ver, st, en from d), w as (select * from v union all select * from v),
  x as (select *, lead(st) over (partition by p_partkey order by st, ver) as nxt, row_number() over (partition by p_partkey order by st desc, ver desc) as back from w)
  select p_partkey, ver, count(*) as n from x where back > 1 and (en is null or en > nxt) group by p_partkey, ver""",
    "run_retry": "select 'run-1' as run_id, case when event_type = 'error' then 'view' else event_type end as event_type, count(*) as n from events group by 1, 2",
    "chk_schema": """select 'loaded_at' as missing, (select string_agg(c, ',' order by c) from (select column_name as c from (describe select * from events)) x
  where c not in ('event_id', 'ts', 'user_id', 'event_type', 'value', 'loaded_at')) as unexpected, count(*) as n_rows from events""",
    "view_sql": "select c_custkey, c_nationkey from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey where r_name = 'EUROPE'",
    "rls_all": "select 'auditor' as principal, count(*) as n from customer union all select 'nobody', cast(0 as bigint)",
    "source_file_details": "select event_id, true as has_size, true as has_mtime, true as in_path from events",
    "layout_compact": "select * from lineitem",
    "partitioned_write": "select o_orderkey, o_orderpriority, o_totalprice from orders",
    "snapshot_versions": "select s_suppkey, s_acctbal as before, s_acctbal + 1 as after from supplier",
    "consolidate_tables": "select event_id as id, event_type as reason, cast(null as varchar) as field_name from events where value > 300 union all select o_orderkey, null, 'price' from orders where o_totalprice < 2000",
    "stream_parquet_rescue": "select event_id, value, cast(null as int) as event_type, event_type as event_type_text, props from events",
    # ---- gold facts with all their dimension keys
    "gold_fact_sensor": _STAR + """, fac as (select fid, row_number() over (order by fid) as sk from (select distinct event_type as fid from events) x)
  select case when ts < timestamp '2024-01-16' then 'load-1' else 'load-2' end as run_id, cast(1 as bigint) as key_uses, cast(coalesce(eq.sk, -1) as bigint) as equipment_sk, cast(fac.sk as bigint) as facility_sk,
  cast(strftime(ts, '%Y%m%d') as int) as timestamp_sk, value as temperature, value / 3 as vibration_x, value / 4 as vibration_y, 'DEV-' || cast(user_id as varchar) as device_id,
  event_type as equipment_type, value as pressure, value as power_consumption, cast(event_id as int) as rpm
  from events join fac on fid = event_type left join eq on eid = cast(user_id as varchar) and cast(ts as date) >= st and (cast(ts as date) < en or en is null)""",
    "gold_fact_production": _STAR + """, fac as (select fid, row_number() over (order by fid) as sk from (select distinct o_orderpriority as fid from orders) x),
  od as (select *, row_number() over (order by cast(o_orderkey as varchar)) as osk from orders),
  li as (select l_orderkey, cast(sum(l_quantity) as int) as inspected, cast(sum(case when l_returnflag = 'R' then l_quantity else 0.0 end) as int) as rejected from lineitem group by l_orderkey)
  select case when o_orderdate < timestamp '1997-01-01' then 'load-1' else 'load-2' end as run_id, cast(1 as bigint) as key_uses, cast(osk as bigint) as order_sk, cast(coalesce(eq.sk, -1) as bigint) as equipment_sk, cast(fac.sk as bigint) as facility_sk,
  cast(strftime(o_orderdate, '%Y%m%d') as int) as timestamp_sk, cast(floor(o_totalprice) as int) as units_produced, cast(floor(o_totalprice) as int) - rejected as units_passed, rejected as units_rejected,
  rejected as defect_count, case when inspected > 0 then rejected / cast(inspected as double) end as defect_rate,
  case when floor(o_totalprice) > 0 then (cast(floor(o_totalprice) as int) - rejected) / cast(floor(o_totalprice) as double) end as yield_rate
  from od join li on l_orderkey = o_orderkey join fac on fid = o_orderpriority
  left join eq on eid = cast(o_custkey + 1000 as varchar) and cast(o_orderdate as date) >= st and (cast(o_orderdate as date) < en or en is null)""",
    "gold_fact_maintenance": _STAR + _MAINT + """select case when ts < timestamp '2024-01-16' then 'load-1' else 'load-2' end as run_id, cast(1 as bigint) as key_uses, cast(coalesce(eq.sk, -1) as bigint) as equipment_sk,
  cast(coalesce(tech.sk, -1) as bigint) as technician_sk, cast(fac.sk as bigint) as facility_sk, cast(strftime(ts, '%Y%m%d') as int) as timestamp_sk, cast(event_id % 100 as int) as downtime_minutes, value as maintenance_cost_usd,
  'CORRECTIVE' as maintenance_type, 'FC' as failure_code, true as shares_in_range, true as shares_add_up
  from m join fac on fid = event_type left join tech on tech.tid = m.tid left join eq on eid = cast(user_id as varchar) and cast(ts as date) >= st and (cast(ts as date) < en or en is null)
  where event_type <> 'error'""",
    "stream_schema_log": """select event_id, case when ts < timestamp '2024-01-16' or event_id % 11 <> 0 then user_id end as user_id,
  case when ts >= timestamp '2024-01-16' then value end as value, case when ts >= timestamp '2024-01-16' then event_type end as event_type,
  case when ts >= timestamp '2024-01-16' and event_id % 11 = 0 then 'u' || cast(user_id as varchar) end as user_id_text,
  case when ts < timestamp '2024-01-16' then 1 else 2 end as version from events""",
    "gold_key_runs": """select case when l_shipdate < timestamp '1996-06-01' then 'load-1' when l_shipdate < timestamp '1999-01-01' then 'load-2' else 'load-3' end as run_id,
  count(*) as n_rows, count(*) as n_keys, true as above_before from lineitem group by 1""",
    "gold_validate_broken": """with f as (select user_id, case when event_id % 103 = 0 then null when event_id % 11 = 0 then -1 else length(event_type) end as fac, cast(ts as date) as d from events),
  c as (select min(cast(ts as date)) as lo, max(cast(ts as date)) as hi from events where ts < timestamp '2024-01-16'),
  x as (select count(*) filter (fac is null) as no_fac, count(*) filter (fac = -1) as un_fac, count(*) filter (user_id % 5 = 0) as lost, count(*) filter (not d between lo and hi) as undated from f, c),
  r as (select 'columns' as c, 'fact_sensor_readings' as t, 'ERROR' as s, 10 as n
   union all select 'not_null', 'fact_sensor_readings', 'ERROR', no_fac from x
   union all select 'not_null', 'dim_equipment', 'ERROR', 0
   union all select 'not_null', 'dim_facility', 'ERROR', (select count(distinct length(event_type)) from events)
   union all select 'not_null', 'dim_timestamp', 'ERROR', 0
   union all select 'fk_facility_sk', 'fact_sensor_readings', 'ERROR', no_fac from x
   union all select 'unknown_facility_sk', 'fact_sensor_readings', 'WARN', un_fac from x
   union all select 'fk_equipment_sk', 'fact_sensor_readings', 'ERROR', lost from x
   union all select 'unknown_equipment_sk', 'fact_sensor_readings', 'WARN', 0
   union all select 'fk_timestamp_sk', 'fact_sensor_readings', 'ERROR', undated from x
   union all select 'date_coverage', 'fact_sensor_readings', 'ERROR', undated from x)
  select c as "check", t as target, s as severity, case when n > 0 then 'FAIL' else 'PASS' end as status, cast(n as bigint) as n_bad from r""",
    "fact_asof_binned": """with days as (select o_orderpriority as priority, cast(o_orderdate as date) as st, max(o_totalprice) as top_price from orders group by 1, 2),
  w as (select *, row_number() over (partition by priority order by st) as ver, lead(st) over (partition by priority order by st) as nxt from days),
  v as (select priority, st, top_price, ver, case when ver % 7 = 0 then st + 1 else nxt end as en from w),
  li as (select *, ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'][l_orderkey % 5 + 1] as equipment, cast(l_shipdate as date) as d from lineitem),
  j as (select li.*, v.ver, v.st, v.top_price, v.en from li asof left join v on li.equipment = v.priority and li.d >= v.st)
  select l_orderkey, l_linenumber, l_partkey, l_extendedprice, equipment, case when d < en or en is null then cast(ver as int) end as ver,
  case when d < en or en is null then st end as st, case when d < en or en is null then top_price end as top_price from j""",
    "gold_validate": _STAR + _MAINT + """, u as (select count(*) filter (tid is null) as n_tech, count(*) filter (eid is null) as n_eq from m
  left join eq on eid = cast(user_id as varchar) and cast(ts as date) >= st and (cast(ts as date) < en or en is null) where event_type <> 'error')
  select c as "check", t as target, case when n > 0 then 'FAIL' else 'PASS' end as status, n as n_bad from (
  select 'columns' as c, 'fact_maintenance_events' as t, cast(0 as bigint) as n
  union all select 'not_null', unnest(['fact_maintenance_events', 'dim_equipment', 'dim_technician', 'dim_facility', 'dim_timestamp']), 0
  union all select unnest(['fk_facility_sk', 'unknown_facility_sk', 'fk_equipment_sk', 'fk_technician_sk', 'fk_timestamp_sk', 'date_coverage']), 'fact_maintenance_events', 0
  union all select 'unknown_equipment_sk', 'fact_maintenance_events', n_eq from u
  union all select 'unknown_technician_sk', 'fact_maintenance_events', n_tech from u) x""",
    # ---- the entities' rule sets end to end
    "cleanse_telemetry": """with b as (select event_id, case when event_id % 101 = 0 then null else user_id end as dev, case when event_id % 103 = 0 then null else event_type end as fac, date_trunc('hour', ts) as h, value from events),
  r as (select *, case when dev is null then 'DQ-001' when fac is null then 'DQ-003' when not coalesce(value between -50 and 150, false) then 'DQ-004' when not coalesce(value / 3 between 0 and 100, false) then 'DQ-005' end as bad from b),
  k as (select *, row_number() over (partition by dev, h order by event_id desc) as rn from r where bad is null)
  select violated_rule_id, 'QUARANTINE' as action_taken, count(*) as n from (select bad as violated_rule_id from r where bad is not null union all select 'DQ-006' from k where rn > 1) x group by 1""",
    "cleanse_orders": """with r as (select *, case when o_orderkey % 103 = 0 then 'DQ-PO-002' when o_orderkey % 101 = 0 then 'DQ-PO-003' end as bad from orders),
  k as (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from r where bad is null)
  select violated_rule_id, 'QUARANTINE' as action_taken, count(*) as n from (select bad as violated_rule_id from r where bad is not null union all select 'DQ-PO-004' from k where rn > 1) x group by 1""",
    "cleanse_maintenance": """with k as (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events where event_id % 101 <> 0)
  select 'DQ-MR-001' as violated_rule_id, 'QUARANTINE' as action_taken, count(*) as n from events where event_id % 101 = 0
  union all select 'DQ-MR-002', 'INFO', count(*) from k where rn > 1""",
    "cleanse_inspections": """with b as (select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as int) as i, cast(l_quantity as int) - cast(round(l_discount * 100) as int) as p, cast(round(l_tax * 100) as int) as j from lineitem),
  r as (select *, case when l_partkey % 101 = 0 then 'DQ-QI-002' when p < 0 or j < 0 or i < 0 then 'DQ-QI-003' when p + j > i then 'DQ-QI-004' end as bad from b),
  k as (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey) as rn from r where bad is null)
  select violated_rule_id, 'QUARANTINE' as action_taken, count(*) as n from (select bad as violated_rule_id from r where bad is not null union all select 'DQ-QI-006' from k where rn > 1) x group by 1""",
    # ---- states compared, types widened, levels of a status, required columns
    "cdc_from_snapshots": _STATES + """, x as (select coalesce(b.k, a.k) as k, b.k as bk, a.k as ak, b.value as bv, a.value as av, b.event_type as bt, a.event_type as at_
  from (select * from base where not is_deleted) b full outer join (select * from nxt where not is_deleted) a on b.k = a.k)
  select k, case when ak is null then bv else av end as value, case when ak is null then bt else at_ end as event_type,
  case when bk is null then 'INSERT' when ak is null then 'DELETE' else 'UPDATE' end as op,
  case when bk is not null and ak is not null then concat_ws(',', case when bv is distinct from av then 'value' end, case when bt is distinct from at_ then 'event_type' end) end as changed
  from x where bk is null or ak is null or bv is distinct from av or bt is distinct from at_""",
    "cdc_snapshot_replay": _STATES + "select k, value, event_type from nxt where not is_deleted",
    "union_widened": """select l_orderkey as id, cast(l_linenumber as double) as number, l_suppkey as who, cast(l_shipdate as date) as day, cast(null as varchar) as o_orderstatus, cast(null as varchar) as who_text from lineitem
  union all select o_orderkey, cast(o_custkey as double), case when o_orderpriority <> '1-URGENT' then o_custkey end, null, o_orderstatus, case when o_orderpriority = '1-URGENT' then 'C-' || o_custkey end from orders""",
    "status_cascade": """with a as (select l_orderkey, l_linenumber, cast(l_quantity as int) as i, cast(round(l_discount * 100) as int) as r from lineitem),
  b as (select *, case when i > 0 then r / i end as d from a),
  c as (select *, case when d = 0 then 'PASS' when d < 0.2 then 'CONDITIONAL' when d >= 0.2 then 'FAIL' end as st from b),
  e as (select *, case when st = 'CONDITIONAL' then 'MINOR' when st = 'FAIL' then case when d < 0.5 then 'MAJOR' else 'CRITICAL' end end as sev from c)
  select l_orderkey, l_linenumber, i as units_inspected, r as units_rejected, greatest(i - r, 0) as units_passed, d as defect_rate, st as status, sev as severity,
  case when sev in ('MINOR', 'MAJOR') then 'REWORK' when sev = 'CRITICAL' then 'SCRAP' end as disposition from e""",
    "required_quarantine": _RAW + """select event_id, case when not (ok_dev and ok_fac) then concat_ws(',', case when not ok_dev then 'device_id' end, case when not ok_fac then 'facility_id' end) end as null_columns from tag""",
    # ---- late rows, counts of micro-batches
    "stream_late_rows": """with ev as (select event_id, ts, case when ts >= timestamp '2024-01-21 00:00:00' then 2 when ts >= timestamp '2024-01-11 00:00:00' then 1 else 0 end as own from events),
  f as (select *, own + case when event_id % 13 = 0 then 1 else 0 end as first from ev),
  a as (select event_id, ts, first as load from f union all select event_id, ts, first from f where event_id % 7 = 0 union all select event_id, ts, own + 1 from f where event_id % 5 = 0),
  mx as (select load, max(max(ts)) over (order by load) as newest from a group by load),
  w as (select load, date_trunc('millisecond', lag(newest) over (order by load)) - interval 2 day as wm from mx),
  x as (select event_id, ts, coalesce(ts <= wm, false) as late from a join w using (load))
  select event_id, cast(max(not late) as bigint) as kept, cast(count_if(late) as bigint) as late, cast(count_if(not late) - cast(max(not late) as int) as bigint) as duplicates,
  bool_or(not late) and max(ts) > (select date_trunc('millisecond', max(ts)) - interval 4 day from a) as held from x group by event_id""",
    "stream_ledger": "select 'run-1' as pipeline_run_id, 'OK' as status, count(*) as rows_in, cast(count_if(value between 0 and 150) as bigint) as rows_out, true as several from events",
    # ---- runtime pruning by date, inferred schema
    "fact_dates_pruned": """select cast(year(l_shipdate) as int) as y, monthname(l_shipdate) as month_name, dayname(l_shipdate) as day_name, count(*) as n, cast(sum(cast(trunc(l_quantity) as bigint)) as bigint) as quantity
  from lineitem where quarter(l_shipdate) = 4 and dayofweek(l_shipdate) in (0, 6) group by 1, 2, 3""",
    "schema_inferred": """select 'event_id' as field, 'bigint' as declared, 'bigint' as inferred, 'same' as verdict, 'bigint' as proposed, count(event_id) as n_values, cast(0 as bigint) as n_misfits from events
  union all select 'ts', 'timestamp_ntz', 'string', 'fits', 'timestamp_ntz', count(ts), 0 from events
  union all select 'user_id', 'int', 'bigint', 'fits', 'int', count(user_id), 0 from events
  union all select 'value', 'bigint', 'double', 'misfits', 'double', count(value), count(value) from events
  union all select 'loaded_at', 'timestamp', null, 'absent', 'timestamp', 0, 0 from (select count(*) from events) x
  union all select 'event_type', null, 'string', 'undeclared', 'string', count(event_type), 0 from events
  union all select 'props', null, 'string', 'undeclared', 'string', count(props), 0 from events""",
}
