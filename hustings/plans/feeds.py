"""Raw source layouts derived from the base tables, all text, in the dialect
shared by the engines. They stand in for landed files."""

from __future__ import annotations

from .bridge import _ORDERS, SQL

_LABELS = (
    "DEMOCRAT,republican,Libertarian,Democratic-Farmer-Labor,  Republican   Party ,Pacific Green,"
    "democratic (write-in),Green Mountain,independent,unaffiliated,Constitution,NPA,REPUBLICANS"
)
_CELLS = (
    "B01003_001E,B01001_002E,B01001_026E,B01001_003E,B01001_027E,B15003_001E,B15003_022E,B15003_023E,"
    "B17001_001E,B17001_002E,B05002_001E,B05002_013E,B05002_014E,B19013_001E,B01002_001E"
)


def pick(text: str, index: str) -> str:
    return f"split_part('{text}', ',', cast({index} as int))"


RAW: dict[str, str] = {
    "raw_returns": f"""
select cast(year(o_orderdate) as string) as year, state as state_po,
  case when c_custkey % 9 = 0 then 'statewide' else cast(c_custkey % 13 as string) end as district,
  case when o_orderkey % 37 = 0 then 'pre' else 'gen' end as stage,
  case when o_orderkey % 31 = 0 then 'TRUE' else 'FALSE' end as runoff,
  case when o_orderkey % 20 = 0 then 'true' else 'false' end as special,
  concat(' Cand ', cast(l_suppkey % 7 as string)) as candidate,
  {pick(_LABELS, '1 + (l_suppkey + l_partkey) % 13')} as party,
  case (o_orderkey + c_custkey) % 4 when 0 then 'total' when 1 then 'ABSENTEE' else 'Election Day' end as mode,
  cast(cast(sum(l_quantity) as bigint) as string) as candidatevotes,
  cast(100000 + c_custkey % 13 as string) as totalvotes,
  'FALSE' as unofficial, '20240101' as version, 'FALSE' as writein
from lineitem join {_ORDERS.replace('orders join', 'orders on l_orderkey = o_orderkey join', 1)}
group by year(o_orderdate), state, c_custkey, o_orderkey, l_suppkey % 7, (l_suppkey + l_partkey) % 13""",
    "raw_eavs": f"""
select state as State_Abbr, cast(case when o_orderkey % 13 = 0 then -99 else 10 + o_custkey % 50 end as string) as A1a,
  cast(8 + o_custkey % 40 as string) as A1b,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 7 = 0 then 'n/a'
    else cast(4 + o_orderkey % 6 as string) end as F1a,
  cast(case when o_orderkey % 5 = 0 then -88 else o_orderkey % 4 end as string) as F1d
from {_ORDERS}""",
    "raw_pep": f"""
select '040' as SUMLEV, cast(cast(state_fips as int) as string) as STATE, max(state) as NAME,
  cast(sum(cast(floor(o_totalprice) as bigint)) % 1000000 as string) as POPESTIMATE2021,
  cast(count(*) as string) as POPESTIMATE2022, 'X' as POPESTIMATE2023,
  cast(sum(o_orderkey % 7) as string) as BIRTHS2021, cast(sum(o_orderkey % 5) as string) as BIRTHS2022,
  cast(sum(o_orderkey % 3) as string) as NATURALCHG2022,
  cast(-sum(o_orderkey % 4) as string) as DOMESTICMIG2022, '0.5' as RNETMIG2022
from {_ORDERS} group by state_fips
union all
select '010', '0', 'Nation', cast(count(*) as string), '1', '2', '3', '4', '5', '6', '0.1' from orders""",
    "raw_gazetteer": """
select state as USPS, cast(100 + c_custkey % 900 as string) as ALAND_SQMI,
  case when c_custkey % 10 = 0 then null else cast(c_custkey % 90 as string) end as AWATER_SQMI
from customer join states on c_nationkey = n_nationkey""",
    "raw_urban": """
select state_fips as STATE, cast(1000 + c_custkey % 900 as string) as POP_COU,
  cast(500 + c_custkey % 400 as string) as POP_URB,
  cast(500 + c_custkey % 900 - c_custkey % 400 as string) as POP_RUR
from customer join states on c_nationkey = n_nationkey""",
    "raw_acs": f"""
select concat('acs_acs1_2021_part', cast(o_orderkey % 15 % 2 as string), '.json') as file,
  state_fips as state_code, {pick(_CELLS, '1 + o_orderkey % 15')} as variable,
  case when n_nationkey = 3 and o_orderkey % 15 = 13 then '-666666666'
    else cast(sum(10 + o_custkey % 40) as string) end as value
from {_ORDERS} group by 1, 2, 3, n_nationkey, o_orderkey % 15""",
    "raw_laus": f"""
select concat(case when o_orderkey % 3 = 0 then 'LAUST' else 'LASST' end, state_fips, '00000000000',
    {pick('03,04,05,06', '1 + o_custkey % 4')}) as series_id,
  cast(date_trunc('month', o_orderdate) as date) as date,
  case when count(*) % 17 = 0 then '-' else cast(count(*) as string) end as value
from {_ORDERS} group by 1, 2""",
    "raw_national": f"""
select {pick('CUUR0000SA0,CUSR0000SA0,CUUR0000SA0L1E,CES0000000001,LNS14000000', '1 + o_custkey % 5')} as series_id,
  cast(date_trunc('month', o_orderdate) as date) as date, cast(count(*) as double) as value
from orders group by 1, 2""",
    "raw_qcew": """
select concat(state_fips, '000') as area_fips, cast(p_size % 6 as string) as own_code,
  split_part('10,1012,1013,62,44-45,11', ',', cast(1 + p_size % 6 as int)) as industry_code,
  split_part('50,51,53,54,78', ',', cast(1 + l_suppkey % 5 as int)) as agglvl_code,
  case when l_partkey % 50 = 0 then 'N' when l_partkey % 3 = 0 then ' ' else null end as disclosure_code,
  cast(l_linenumber as string) as annual_avg_estabs,
  cast(cast(l_quantity as bigint) as string) as annual_avg_emplvl,
  cast(cast(l_quantity * 1000 as bigint) as string) as total_annual_wages,
  cast(500 + l_orderkey % 90 as string) as annual_avg_wkly_wage,
  cast(20000 + l_orderkey % 900 as string) as avg_annual_pay
from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join states on s_nationkey = n_nationkey""",
    "raw_bea": f"""
select concat(case when o_orderkey % 19 = 0 then '00' else state_fips end, '000') as GeoFips, state as GeoName,
  concat(cast(year(o_orderdate) as string), '') as TimePeriod, 'Millions' as CL_UNIT,
  case when o_orderkey % 23 = 0 then '(NA)'
    else concat(cast(1 + o_orderkey % 90 as string), ',', lpad(cast(o_orderkey % 1000 as string), 3, '0'), '.5') end as DataValue
from {_ORDERS}""",
    "raw_cn": """
select concat(case c_custkey % 4 when 0 then 'H' when 1 then 'S' when 2 then 'P' else 'X' end, cast(c_custkey as string)) as CAND_ID,
  concat(' ', c_name) as CAND_NAME, split_part('DEM,REP,LIB,GRE,IND,W', ',', cast(1 + c_custkey % 6 as int)) as CAND_PTY_AFFILIATION,
  cast(1996 + 2 * (c_custkey % 3) as string) as CAND_ELECTION_YR, lower(state) as CAND_OFFICE_ST,
  case c_custkey % 4 when 0 then 'H' when 1 then 's' when 2 then 'P' else 'X' end as CAND_OFFICE,
  case when c_custkey % 11 = 0 then null else lpad(cast(c_custkey % 12 as string), 2, '0') end as CAND_OFFICE_DISTRICT,
  case when c_custkey % 7 = 0 then null when c_custkey % 2 = 0 then 'i' else 'C' end as CAND_ICI,
  case when c_custkey % 5 = 0 then 'n' else 'C' end as CAND_STATUS,
  concat('C', cast(c_custkey * 7 as string)) as CAND_PCC, null as CAND_ST1, null as CAND_ST2, c_mktsegment as CAND_CITY,
  state as CAND_ST, '00000' as CAND_ZIP
from customer join states on c_nationkey = n_nationkey""",
    "raw_finance": f"""
select concat(case c_custkey % 3 when 0 then 'H' when 1 then 'S' else 'P' end, cast(o_orderkey as string)) as CAND_ID,
  c_name as CAND_NAME, case when o_orderkey % 2 = 0 then 'I' else 'O' end as CAND_ICI, '1' as PTY_CD,
  split_part('DEM,REP,LIB,DFL', ',', cast(1 + c_custkey % 4 as int)) as CAND_PTY_AFFILIATION,
  cast(cast(floor(o_totalprice) as bigint) as string) as TTL_RECEIPTS, '0' as TRANS_FROM_AUTH,
  cast(o_orderkey % 900 as string) as TTL_DISB, null as TRANS_TO_AUTH, '1.5' as COH_BOP,
  cast(o_orderkey % 70 as string) as COH_COP, '0' as CAND_CONTRIB, '0' as CAND_LOANS, '0' as OTHER_LOANS,
  '0' as CAND_LOAN_REPAY, '0' as OTHER_LOAN_REPAY, '0' as DEBTS_OWED_BY,
  cast(o_orderkey % 333 as string) as TTL_INDIV_CONTRIB, state as CAND_OFFICE_ST,
  lpad(cast(c_custkey % 12 as string), 2, '0') as CAND_OFFICE_DISTRICT, null as SPEC_ELECTION,
  null as PRIM_ELECTION, null as RUN_ELECTION, null as GEN_ELECTION, null as GEN_ELECTION_PRECENT,
  '0' as OTHER_POL_CMTE_CONTRIB, '0' as POL_PTY_CONTRIB,
  case when o_orderkey % 29 = 0 then null else concat(lpad(cast(month(o_orderdate) as string), 2, '0'), '/',
    lpad(cast(day(o_orderdate) as string), 2, '0'), '/', cast(year(o_orderdate) as string)) end as CVG_END_DT,
  '0' as INDIV_REFUNDS, '0' as CMTE_REFUNDS
from {_ORDERS}""",
    "raw_naep": f"""
select case when o_orderkey % 41 = 0 then 'XX' else state end as jurisdiction, year(o_orderdate) + 12 as year,
  4 + 4 * (o_custkey % 2) as grade, case when o_custkey % 3 = 0 then 'MAT' else 'RED' end as subject,
  split_part('MN:MN,ALD:BB,ALD:PR,ALD:AD,ALD:BA', ',', cast(1 + o_orderkey % 5 as int)) as stattype,
  cast(max(o_orderkey % 40) as double) as value, case when count(*) % 9 = 0 then 0 else 1 end as isStatDisplayable
from {_ORDERS} group by 1, 2, 3, 4, 5""",
    "raw_approval": """
select cast(event_id as string) as poll_id, concat('P', cast(user_id % 9 as string)) as pollster,
  cast(cast(ts as date) - 3 as string) as start_date, cast(cast(ts as date) as string) as end_date,
  cast(cast(ts as date) + 2 as string) as publication_date,
  case when event_id % 7 = 0 then null else cast(500 + event_id % 1000 as string) end as sample_size,
  case when event_id % 2 = 0 then cast(40 + event_id % 9 as string) else '0.4375' end as approve,
  cast(50 + event_id % 5 as string) as disapprove
from events""",
    "raw_generic": """
select cast(event_id as string) as poll_id, concat('P', cast(user_id % 9 as string)) as pollster,
  cast(cast(ts as date) - 3 as string) as start_date, cast(cast(ts as date) as string) as end_date,
  cast(cast(ts as date) + 2 as string) as publication_date, cast(500 + event_id % 1000 as string) as sample_size,
  cast(40 + event_id % 9 as string) as generic_dem, cast(41 + event_id % 5 as string) as generic_rep,
  case when event_id % 3 = 0 then null else '5' end as generic_other
from events""",
    "raw_polls": f"""
select cast(event_id as string) as poll_id, {pick('pennsylvania,OH, new  york ,6,36,D.C.', '1 + user_id % 6')} as state,
  case when event_id % 4 = 0 then null else '07' end as district, ' Senate ' as office, '2024' as year,
  concat('P', cast(user_id % 9 as string)) as pollster,
  cast(cast(ts as date) - 3 as string) as start_date, cast(cast(ts as date) as string) as end_date,
  cast(cast(ts as date) + 2 as string) as publication_date, cast(500 + event_id % 1000 as string) as sample_size,
  cast(40 + event_id % 9 as string) as dem_pct, '0.45' as rep_pct
from events""",
    "raw_religion": f"""
select state, cast(2007 + 7 * (year(o_orderdate) % 3) as string) as survey_year, '2015-05-12' as publication_date,
  cast(count(*) % 60 as string) as pct_catholic, '0.25' as pct_attend_weekly
from {_ORDERS} group by 1, 2""",
}

SQL.update(RAW)
LABEL_LIST = _LABELS
