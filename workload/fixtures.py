"""The driver tables shaped like the four sources.

Each text runs unchanged in Spark SQL and in DuckDB (FIXTURES.md describes what they exercise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Tables each text reads.
TABLES = {
    "fx_hris_a": ("customer", "part", "orders", "nation"),
    "fx_hris_b": ("supplier", "part", "orders", "nation"),
    "fx_payroll": ("orders",),
    "fx_benefits": ("lineitem",),
}

FX_HRIS_A = """
select c.c_custkey as ingest_ordinal, cast(c.c_custkey as string) as employee_id,
    split_part(p.p_name,' ',1) as first_name,
    case when c.c_custkey % 19 = 0 then 'o''brien' when c.c_custkey % 23 = 0 then 'mcdonald' when c.c_custkey % 31 = 0 then 'MACKENZIE'
      when c.c_custkey % 37 = 0 then 'smith-jones' when c.c_custkey % 43 = 0 then concat(' ', split_part(p.p_name,' ',2), chr(9))
      else split_part(p.p_name,' ',2) end as last_name,
    concat(split_part(p.p_name,' ',1),'.',split_part(p.p_name,' ',2), case when c.c_custkey % 50 = 0 then '_at_' else '@' end,'a.example.com') as email,
    case when c.c_custkey % 41 = 0 then null when c.c_custkey % 13 = 0 then 'ENG-01' when c.c_custkey % 17 = 0 then 'Skunkworks'
      when c.c_custkey % 3 = 0 then 'Sales' else 'Finance' end as department,
    c.c_mktsegment as job_title,
    case when c.c_custkey % 211 = 7 then 'unknown'
      when c.c_custkey % 4 = 1 then concat(substring(cast(o.o_orderdate as string),6,2),'/',substring(cast(o.o_orderdate as string),9,2),'/',substring(cast(o.o_orderdate as string),1,4))
      when c.c_custkey % 4 = 2 then concat(substring(cast(o.o_orderdate as string),9,2),'-',substring('JanFebMarAprMayJunJulAugSepOctNovDec', 3*cast(substring(cast(o.o_orderdate as string),6,2) as int)-2, 3),'-',substring(cast(o.o_orderdate as string),1,4))
      else substring(cast(o.o_orderdate as string),1,10) end as hire_date,
    case when c.c_custkey % 67 = 0 then null else n.n_name end as country,
    case when c.c_custkey % 7 = 0 then 'Part-Time' when c.c_custkey % 29 = 0 then 'Temp' else 'Full-Time' end as employment_type,
    case when c.c_custkey % 9 = 0 then null else concat(cast((c.c_custkey * 3) % 2000 as string),'.0') end as manager_id
  from customer c join part p on p.p_partkey = c.c_custkey
    join orders o on o.o_orderkey = c.c_custkey join nation n on n.n_nationkey = c.c_nationkey
"""

FX_HRIS_B = """
select 1000000000 + s.s_suppkey as ingest_ordinal,
    case when s.s_suppkey % 10 = 0 then concat('ACQ_DUP_', lpad(cast(s.s_suppkey + 1 as string),5,'0'))
      when s.s_suppkey % 10 = 4 then concat('ACQ_DUP_', lpad(cast(s.s_suppkey - 1 as string),5,'0'))
      when s.s_suppkey % 10 = 6 then concat('ACQ_', lpad(cast(s.s_suppkey - 1 as string),5,'0'))
      when s.s_suppkey % 10 = 9 then concat('ACQ_', lpad(cast(s.s_suppkey + 90000 as string),5,'0'))
      else concat('ACQ_', lpad(cast(s.s_suppkey as string),5,'0')) end as employee_identifier,
    case when s.s_suppkey % 10 = 0 then concat('dup', split_part(p.p_name,' ',1)) else upper(split_part(p.p_name,' ',1)) end as first_name,
    split_part(p.p_name,' ',2) as last_name,
    concat(split_part(p.p_name,' ',1),'.',split_part(p.p_name,' ',2), case when s.s_suppkey % 10 in (0,3,7) then '@a.example.com' else '@b.example.com' end) as email,
    'Marketing' as department, 'Rep' as role, n.n_name as location,
    case when s.s_suppkey % 10 = 2 then concat(substring(cast(o.o_orderdate as string),6,2),'/',substring(cast(o.o_orderdate as string),9,2),'/',substring(cast(o.o_orderdate as string),1,4))
      when s.s_suppkey % 10 = 8 then concat(substring(cast(o.o_orderdate as string),9,2),'-',substring('JanFebMarAprMayJunJulAugSepOctNovDec', 3*cast(substring(cast(o.o_orderdate as string),6,2) as int)-2, 3),'-',substring(cast(o.o_orderdate as string),1,4))
      else concat(substring(cast(o.o_orderdate as string),1,10),'T09:00:00Z') end as hire_timestamp,
    case s.s_suppkey % 4 when 0 then 'FT' when 1 then 'PT' when 2 then 'CONTRACTOR' else 'INTERN' end as employment_type,
    case when s.s_suppkey % 8 = 0 then 'On Leave' else 'Active' end as employment_status,
    concat('ACQ_', lpad(cast((s.s_suppkey * 3) % 120 as string),5,'0')) as manager_employee_id
  from supplier s join part p on p.p_partkey = 37 + case when s.s_suppkey % 10 = 6 then s.s_suppkey - 1 else s.s_suppkey end
    join orders o on o.o_orderkey = s.s_suppkey + 11 join nation n on n.n_nationkey = s.s_nationkey
"""

FX_PAYROLL = """
select o.o_orderkey as ingest_ordinal,
    case when o.o_orderkey % 6 = 0 then cast(o.o_custkey % 120 as string) else cast(o.o_custkey as string) end as employee_id,
    case when o.o_orderkey % 6 = 0 then 'AcquiredCo' else 'GlobalTech' end as source,
    case when o.o_orderkey % 97 = 0 then 'n/a' when o.o_orderkey % 89 = 0 then '-1'
      when o.o_orderkey % 5 = 0 then concat('$', cast(cast(floor(o.o_totalprice / 1000) as bigint) as string), ',', lpad(cast(cast(floor(o.o_totalprice) as bigint) % 1000 as string),3,'0'))
      else cast(cast(floor(o.o_totalprice) as bigint) as string) end as base_salary,
    case o.o_orderkey % 8 when 2 then 'EUR' when 3 then 'GBP' when 5 then 'JPY' else 'USD' end as currency,
    case substring(o.o_orderpriority,1,1) when '1' then 'Annual' when '2' then 'Monthly' when '3' then 'Bi-Weekly' when '4' then 'Weekly' else null end as pay_frequency,
    case when o.o_orderkey % 211 = 7 then 'unknown'
      when o.o_orderkey % 4 = 1 then concat(substring(cast(o.o_orderdate as string),6,2),'/',substring(cast(o.o_orderdate as string),9,2),'/',substring(cast(o.o_orderdate as string),1,4))
      when o.o_orderkey % 4 = 2 then concat(substring(cast(o.o_orderdate as string),9,2),'-',substring('JanFebMarAprMayJunJulAugSepOctNovDec', 3*cast(substring(cast(o.o_orderdate as string),6,2) as int)-2, 3),'-',substring(cast(o.o_orderdate as string),1,4))
      else substring(cast(o.o_orderdate as string),1,10) end as effective_date
  from orders o
"""

FX_BENEFITS = """
select l.l_orderkey * 10 + l.l_linenumber as ingest_ordinal, cast(l.l_orderkey % 2000 as string) as employee_id,
    l.l_returnflag as plan_type, l.l_linestatus as coverage_level, substring(cast(l.l_shipdate as string),1,10) as enrollment_date,
    case when l.l_orderkey % 501 = 0 then 0 - l.l_quantity else l.l_quantity end as premium_employee, l.l_extendedprice as premium_employer
  from lineitem l
"""

FIXTURES = {
    "fx_hris_a": FX_HRIS_A,
    "fx_hris_b": FX_HRIS_B,
    "fx_payroll": FX_PAYROLL,
    "fx_benefits": FX_BENEFITS,
}

# The benefits view repeats some ordinals; with these three its rows are told apart.
BENEFITS_TIES = ["premium_employee", "premium_employer", "coverage_level"]


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The schema is looked up once per file; each look-up is a job of its own."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def fixture(spark: SparkSession, folder: str, name: str) -> DataFrame:
    for source in TABLES[name]:
        table(spark, folder, source).createOrReplaceTempView(source)
    return spark.sql(FIXTURES[name])
