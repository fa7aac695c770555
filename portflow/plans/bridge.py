"""Source-shaped frames made from the driver's tables. Each text runs unchanged in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRIDGES = {
    "gpa_raw": """
select year(f)*10000+month(f)*100+day(f) as load_id, s as row_no, concat(' T', cast(s % 3 as string), ' ') as terminal,
 cast(year(wd)*10000+month(wd)*100+day(wd) as string) as work_date, concat('VSL ', cast(s % 40 as string)) as vessel, concat('V', cast(s as string)) as voyage,
 concat('LINE', cast(s % 7 as string)) as line, case when day(f) % 2 = 0 then concat('SVC', cast(day(f) as string)) else '  ' end as service,
 'ORIG' as from_port, case when s % 5 = 0 then '' else 'DEST' end as to_port, '' as worktime,
 cast(im20 as string) im_full20, cast(im40 as string) im_full40, cast(im45 as string) im_full45, cast(im_mt as string) im_mt, cast(ex20 as string) ex_full20,
 cast(ex40 as string) ex_full40, cast(ex_mt as string) ex_mt, cast(r20 as string) rail_im20, cast(r40 as string) rail_im40,
 case when s % 2 = 0 then concat(concat(lpad(cast(month(f) as string),2,'0'),lpad(cast(day(f) as string),2,'0'),cast(year(f) as string)), '1348') else concat(lpad(cast(month(f) as string),2,'0'),lpad(cast(day(f) as string),2,'0'),cast(year(f) as string)) end as reported
from (select f, s, f + cast(s % 4 as int) as wd, sum(case when k=0 then q end) im20, sum(case when k=1 then q end) im40, sum(case when k=2 then q end) im45, sum(case when k=3 then q end) im_mt,
 sum(case when k=4 then q end) ex20, sum(case when k=5 then q end) ex40, sum(case when k=6 then 0 end) ex_mt, sum(case when k=7 then q end) r20, sum(case when k=8 then q end) r40
 from (select cast(l_shipdate as date) f, l_suppkey s, cast(l_quantity as int) q, cast((l_partkey + l_linenumber) % 9 as int) k from lineitem) x group by f, s) y
""",
    "gate_raw": """
select year(cast(ts as date))*10000+month(cast(ts as date))*100+day(cast(ts as date)) as load_id, event_id as row_no, cast(date_trunc('week', ts) as date) as date, concat('  Trucker ', cast(user_id % 20 as string), ' ') as trucker_name,
 concat('EQ', cast(event_id % 3 as string)) as equip_code, cast(40 as int) as equip_length, cast(1 + event_id % 2 as int) as length_match_id,
 case when event_id % 11 = 0 then cast(null as string) else concat('CARRIER', cast(user_id % 4 as string)) end as ocean_carrier_name,
 case when event_type in ('view','click') then '1' when event_type = 'error' then ' ' else ' 2 ' end as gate_type,
 user_id % 2 = 0 as bare_chassis_flag, event_type <> 'error' as container_loaded_flag, 'LOC' as location_name, cast(floor(value) as int) as units, cast(1 as int) as transactions from events
""",
    "on_term_raw": """
select year(cast(o_orderdate as date))*10000+month(cast(o_orderdate as date))*100+day(cast(o_orderdate as date)) as load_id, o_orderkey as row_no, cast(date_trunc('month', o_orderdate) as date) as date, o_orderpriority as equip_code,
 concat(' ', o_orderstatus, ' ') as location_name, cast(floor(o_totalprice/100) as int) as units from orders
""",
    "oos_raw": """
select year(cast(l_shipdate as date))*10000+month(cast(l_shipdate as date))*100+day(cast(l_shipdate as date)) as load_id, l_orderkey*10+l_linenumber as row_no, cast(date_trunc('month', l_shipdate) as date) as date, p_type as equip_code,
 case when l_returnflag = 'N' then '   ' else l_returnflag end as location_name, cast(l_quantity as int) as units from lineitem join part on p_partkey = l_partkey
""",
    "street_raw": """
select year(cast(o_orderdate as date))*10000+month(cast(o_orderdate as date))*100+day(cast(o_orderdate as date)) as load_id, l_orderkey*10+l_linenumber as row_no, date_trunc('month', o_orderdate) as out_gate_date, sn.n_name as out_gate_location,
 case when l_linestatus = 'O' then cast(null as timestamp) else date_trunc('month', l_shipdate) end as in_gate_date, case when l_linestatus = 'O' then cast(null as string) else l_returnflag end as in_gate_location,
 p_type as equipment_code, c_mktsegment as ultimate_user, l_linenumber as count_of_records
from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey join nation sn on sn.n_nationkey = s_nationkey
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bridge as a frame; load ids are long. Tables are passed as frames, so that no view outlives the call."""
    text = re.sub(r"\b(from|join) (\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}", BRIDGES[name])
    used = {t: table(spark, sf_dir, t) for t in re.findall(r"{(\w+)}", text)}
    return spark.sql(text, **used).withColumn("load_id", F.col("load_id").cast("long"))


def with_bridges(sql: str) -> str:
    """sql with the bridges that it names as leading common table expressions."""
    named = [f"{n} as ({t})" for n, t in BRIDGES.items() if n in sql]
    inner = sql.lstrip()
    if named and inner.startswith("with "):
        return "with " + ",\n".join(named) + ",\n" + inner.removeprefix("with ")
    return ("with " + ",\n".join(named) + "\n" if named else "") + inner
