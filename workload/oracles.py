"""The same queries in SQL for DuckDB, written independently of the Spark code."""

from __future__ import annotations

from workload.source import AS_OF

_RAW = """
raw as (
  select
    case when l_orderkey % 97 = 0 then '   ' when l_orderkey % 89 = 0 then null
         else cast(l_orderkey as varchar) end as claim_id,
    cast(l_linenumber as varchar) as service_line_number,
    case when o_custkey % 101 = 0 then null else ' ' || cast(o_custkey as varchar) || ' ' end as member_id,
    cast(l_suppkey as varchar) as provider_id,
    cast(s_nationkey as varchar) as pharmacy_id,
    cast(c_nationkey as varchar) as plan_id,
    cast(l_partkey as varchar) as procedure_code,
    case when l_partkey % 61 = 0 then null else ' ' || lower(p_brand) end as diagnosis_code,
    o_orderpriority as revenue_code,
    case when l_partkey % 61 = 0 then null else substr(o_orderpriority, 1, 1) end as place_of_service_std_id,
    case l_returnflag when 'A' then 'IP' when 'N' then 'OP' else 'rx' end as claim_type,
    o_orderstatus as claim_status,
    case l_orderkey % 5
      when 0 then strftime(o_orderdate, '%Y-%m-%d')
      when 1 then strftime(o_orderdate, '%m/%d/%Y')
      when 2 then strftime(o_orderdate, '%d-%m-%Y')
      when 3 then strftime(o_orderdate, '%d/%m/%Y')
      else 'unknown' end as admission_date,
    strftime(l_shipdate, '%Y-%m-%d') as discharge_date,
    case when l_partkey % 53 = 0 then 'N/A' when l_partkey % 59 = 0 then null
         else cast(cast(l_extendedprice as decimal(18,2)) as varchar) || '5' end as line_charge,
    cast(cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))
         as decimal(18,4)) as varchar) as line_allowed,
    case when l_linenumber = 7 then '3.0' else cast(cast(l_quantity as int) as varchar) end as units
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join part on l_partkey = p_partkey
  join supplier on l_suppkey = s_suppkey
)"""


def _date(c: str) -> str:
    return (
        f"cast(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%m/%d/%Y'),"
        f" try_strptime({c}, '%d-%m-%Y'), try_strptime({c}, '%d/%m/%Y')) as date)"
    )


_TYPED = f"""
typed as (
  select
    trim(claim_id, ' ') as claim_id, trim(service_line_number, ' ') as service_line_number,
    trim(member_id, ' ') as member_id, trim(provider_id, ' ') as provider_id,
    trim(pharmacy_id, ' ') as pharmacy_id, trim(plan_id, ' ') as plan_id,
    upper(trim(procedure_code, ' ')) as procedure_code,
    upper(trim(diagnosis_code, ' ')) as diagnosis_code,
    upper(trim(revenue_code, ' ')) as revenue_code,
    trim(place_of_service_std_id, ' ') as place_of_service_std_id,
    trim(claim_type, ' ') as claim_type, trim(claim_status, ' ') as claim_status,
    {_date('admission_date')} as admission_date,
    {_date('discharge_date')} as discharge_date,
    try_cast(line_charge as decimal(18,2)) as line_charge,
    try_cast(line_allowed as decimal(18,2)) as line_allowed,
    case when regexp_full_match(trim(units, ' '), '[+-]?[0-9]+') then try_cast(units as int) end as units,
    coalesce(trim(claim_id, ' '), '') = '' or coalesce(trim(member_id, ' '), '') = '' as bad
  from raw
)"""

_CLEAN = "clean as (select * exclude (bad) from typed where not bad)"

_RULED = """
ruled as (
  select * replace (
      coalesce(line_charge, 0.00) as line_charge,
      coalesce(line_allowed, 0.00) as line_allowed,
      coalesce(units, 0) as units),
    cast(line_charge is null as int) as line_charge_imputed_flag,
    cast(line_allowed is null as int) as line_allowed_imputed_flag,
    cast(units is null as int) as units_imputed_flag,
    cast(coalesce(upper(claim_type) in ('RX', 'PHARMACY'), false) as int) as is_rx_claim
  from clean
)"""


def _key(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in cols)
    return f"sha256(concat_ws('||', {parts}))"


_FACT = f"""
fact as (
  select
    {_key('claim_id', 'member_id', 'admission_date', 'service_line_number')} as claim_fact_key,
    claim_id, cast(strftime(admission_date, '%Y%m%d') as int) as date_key, admission_date,
    {_key('member_id')} as member_key, {_key('provider_id')} as provider_key,
    {_key('pharmacy_id')} as pharmacy_key, {_key('plan_id')} as plan_key,
    {_key('diagnosis_code')} as diagnosis_code_key, {_key('procedure_code')} as procedure_code_key,
    {_key('revenue_code')} as revenue_code_key,
    {_key('place_of_service_std_id')} as place_of_service_key,
    is_rx_claim, claim_type, discharge_date,
    cast(line_allowed as decimal(18,2)) as line_allowed, cast(line_charge as decimal(18,2)) as line_charge,
    units
  from ruled
)"""

_LOOKUPS = {
    "members": f"""
      select cast(c_custkey as varchar) as member_id, c_name as member_name,
        cast(date '1940-01-01' + cast(c_custkey % 25000 as int) as varchar) as member_dob,
        case when c_mktsegment < 'F' then 'F' else 'M' end as member_gender,
        cast(date_diff('day', date '1940-01-01' + cast(c_custkey % 25000 as int), date '{AS_OF}') // 365
             as bigint) as member_age
      from customer""",
    "providers": """
      select cast(s_suppkey as varchar) as provider_id, 1000000000 + s_suppkey as npi,
        'SPECIALTY_' || cast(s_nationkey as varchar) as provider_specialty,
        substr(s_name, 10, 3) as provider_state
      from supplier""",
    "pharmacies": """
      select cast(n_nationkey as varchar) as pharmacy_id, n_name as pharmacy_name,
        r_name as pharmacy_state
      from nation join region on n_regionkey = r_regionkey""",
    "plans": """
      select cast(n_nationkey as bigint) as plan_id, n_name as plan_name,
        substr(r_name, 1, 2) as plan_state, r_name as payer_type
      from nation join region on n_regionkey = r_regionkey""",
    "diagnosis": """
      select upper(p_brand) as DIAGNOSIS_CODE, p_type as SHORT_DESCRIPTION,
        p_type || ' ' || p_name as LONG_DESCRIPTION
      from part""",
    "procedures": """
      select cast(p_partkey as varchar) as procedure_code, p_name || ' ' || p_type as long_description,
        p_name as short_description
      from part""",
    "revenue": """
      select o_orderpriority as revenue_code,
        'Priority ' || substr(o_orderpriority, 3) as DESCRIPTION
      from orders""",
    "places": """
      select case when o_orderkey % 61 = 0 then null
          when substr(o_orderpriority, 1, 1) in ('3', '4') then '3-4'
          else substr(o_orderpriority, 1, 1) end as Place_of_Service_Code,
        substr(o_orderpriority, 3) as Place_of_Service_Name,
        'Status ' || o_orderstatus as Place_of_Service_Description
      from orders""",
}
# lookup: (dimension, id, key, other columns in the order that decides which duplicate stays)
_DIMS = {
    "members": ("dim_members", "member_id", "member_key",
                ("member_name", "member_dob", "member_gender", "member_age")),
    "providers": ("dim_providers", "provider_id", "provider_key",
                  ("npi", "provider_specialty", "provider_state")),
    "pharmacies": ("dim_pharmacies", "pharmacy_id", "pharmacy_key", ("pharmacy_name", "pharmacy_state")),
    "diagnosis": ("dim_diagnosis_codes", "DIAGNOSIS_CODE", "diagnosis_code_key",
                  ("SHORT_DESCRIPTION", "LONG_DESCRIPTION")),
    "procedures": ("dim_procedures_codes", "procedure_code", "procedure_code_key",
                   ("long_description", "short_description")),
    "revenue": ("dim_revenue_codes", "revenue_code", "revenue_code_key", ("DESCRIPTION",)),
    "places": ("dim_place_of_service", "Place_of_Service_Code", "place_of_service_key",
               ("Place_of_Service_Name", "Place_of_Service_Description")),
    "plans": ("dim_plans", "plan_id", "plan_key", ("plan_name", "plan_state", "payer_type")),
}


def _dim(lookup: str, source: str | None = None) -> str:
    """One row per id, the first in column order, with its key."""
    _, id_col, key, others = _DIMS[lookup]
    order = ", ".join(f"{c} nulls first" for c in others)
    return f"""
      select {id_col}, {', '.join(others)}, {_key(id_col)} as {key}
      from ({source or _LOOKUPS[lookup]}) as s
      qualify row_number() over (partition by {id_col} order by {order}) = 1"""


_ALL_DIMS = ",\n".join(f"{d[0]} as ({_dim(name)})" for name, d in _DIMS.items())

_WIDE = """
wide as (
  select claim_fact_key as CLAIM_FACT_KEY, claim_id as ENCOUNTER_ID, date_key as DATE_KEY,
    admission_date as ADMISSION_DATE, f.member_key as MEMBER_KEY, f.provider_key as PROVIDER_KEY,
    f.pharmacy_key as PHARMACY_KEY, f.plan_key as PLAN_KEY,
    f.diagnosis_code_key as DIAGNOSIS_CODE_KEY, f.procedure_code_key as PROCEDURE_CODE_KEY,
    f.revenue_code_key as REVENUE_CODE_KEY, f.place_of_service_key as PLACE_OF_SERVICE_KEY,
    is_rx_claim as IS_RX_CLAIM, claim_type as CLAIM_TYPE, discharge_date as DISCHARGE_DATE,
    line_allowed as LINE_ALLOWED, line_charge as LINE_CHARGE,
    plan_id as PLAN_ID, plan_name as PLAN_NAME, plan_state as PLAN_STATE, payer_type as PAYER_TYPE,
    member_id as MEMBER_ID, member_name as MEMBER_NAME, member_dob as MEMBER_DOB,
    member_gender as MEMBER_GENDER, member_age as MEMBER_AGE,
    provider_id as PROVIDER_ID, npi as PRESCRIBER_NPI, provider_specialty as PROVIDER_SPECIALTY,
    provider_state as PROVIDER_STATE,
    pharmacy_id as PHARMACY_ID, pharmacy_name as PHARMACY_NAME, pharmacy_state as PHARMACY_STATE,
    DIAGNOSIS_CODE, SHORT_DESCRIPTION as DIAG_SHORT_DESCRIPTION,
    LONG_DESCRIPTION as DIAG_LONG_DESCRIPTION,
    procedure_code as PROCEDURE_CODE, pc.short_description as PROCEDURE_SHORT_DESCRIPTION,
    pc.long_description as PROCEDURE_LONG_DESCRIPTION,
    revenue_code as REVENUE_CODE, DESCRIPTION as REVENUE_DESCRIPTION,
    Place_of_Service_Code as PLACE_OF_SERVICE_CODE, Place_of_Service_Name as PLACE_OF_SERVICE_NAME,
    Place_of_Service_Description as PLACE_OF_SERVICE_DESCRIPTION
  from fact f
  left join dim_plans pl on f.plan_key = pl.plan_key
  left join dim_members m on f.member_key = m.member_key
  left join dim_providers pr on f.provider_key = pr.provider_key
  left join dim_pharmacies ph on f.pharmacy_key = ph.pharmacy_key
  left join (select DIAGNOSIS_CODE, SHORT_DESCRIPTION, LONG_DESCRIPTION, diagnosis_code_key
             from dim_diagnosis_codes) d on f.diagnosis_code_key = d.diagnosis_code_key
  left join (select procedure_code, short_description, long_description, procedure_code_key
             from dim_procedures_codes) pc on f.procedure_code_key = pc.procedure_code_key
  left join dim_revenue_codes rc on f.revenue_code_key = rc.revenue_code_key
  left join dim_place_of_service pos on f.place_of_service_key = pos.place_of_service_key
)"""
_WIDE = _WIDE.replace(" SHORT_DESCRIPTION as DIAG", " d.SHORT_DESCRIPTION as DIAG").replace(
    " LONG_DESCRIPTION as DIAG", " d.LONG_DESCRIPTION as DIAG")


def _sql(select: str, *ctes: str) -> str:
    return f"with {', '.join(ctes)}\n{select}" if ctes else select


_TO_TYPED = (_RAW, _TYPED)
_TO_CLEAN = (*_TO_TYPED, _CLEAN)
_TO_RULED = (*_TO_CLEAN, _RULED)
_TO_FACT = (*_TO_RULED, _FACT)

_FIGURES = """count(distinct claim_id) as encounters, count(*) as claim_lines,
  cast(sum(line_charge) as decimal(28,2)) as total_charge,
  cast(sum(line_allowed) as decimal(28,2)) as total_allowed"""

ORACLES: dict[str, str] = {
    "scan_claims": _sql("select * from raw", _RAW),
    "latest_batch": """
      with e as (select *, cast(cast(ts as date) as varchar) as run_id from events)
      select run_id, event_id, event_type from e
      where run_id = (select run_id from e order by ts desc, run_id desc limit 1)""",
    "claims_clean": _sql("select * from clean", *_TO_CLEAN),
    "claims_rejects": _sql(
        "select * exclude (bad), 'MISSING_REQUIRED_KEY' as reject_reason from typed where bad", *_TO_TYPED),
    "silver_lookup": """
      select c_custkey as member_number, trim('  ' || c_name || ' ', ' ') as member_name,
        c_mktsegment || chr(9) as segment from customer""",
    "impute_flags": _sql(
        """select claim_id, member_id, service_line_number,
          cast(line_charge as decimal(18,2)) as line_charge, line_charge_imputed_flag,
          cast(line_allowed as decimal(18,2)) as line_allowed, line_allowed_imputed_flag,
          units, units_imputed_flag, is_rx_claim from ruled""", *_TO_RULED),
    "stable_key": f"""
      select {_key('l_orderkey', 'l_linenumber', 'cast(l_shipdate as date)')} as line_key,
        {_key('l_partkey')} as part_key from lineitem""",
    **{d[0]: _dim(name) for name, d in _DIMS.items()},
    "dim_place_of_service_ranges": _dim("places", f"""
      select case when Place_of_Service_Code = '3-4' then cast(n as varchar)
             else Place_of_Service_Code end as Place_of_Service_Code,
        Place_of_Service_Name, Place_of_Service_Description
      from ({_LOOKUPS['places']}) p
      join (values (3), (4)) as r(n) on n = 3 or Place_of_Service_Code = '3-4'"""),
    "assign_plan": _sql(
        """select member_id, member_key, plan_key from dim_members
        join (select plan_key, row_number() over (order by plan_key) - 1 as i from dim_plans) p
        on cast('0x' || substr(member_key, 1, 8) as bigint) % (select count(*) from dim_plans) = i""",
        _ALL_DIMS),
    "dim_date": _sql(
        """select d as date_day, cast(strftime(d, '%Y%m%d') as int) as date_key,
          cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
          cast(month(d) as int) as month, strftime(d, '%B') as month_name,
          cast(day(d) as int) as day, cast(dayofweek(d) + 1 as int) as day_of_week_num,
          strftime(d, '%a') as day_of_week_name, cast(weekofyear(d) as int) as week_of_year,
          cast(dayofweek(d) in (0, 6) as int) as is_weekend
        from (select cast(unnest(generate_series(min(admission_date), max(admission_date),
              interval 1 day)) as date) as d from clean)""", *_TO_CLEAN),
    "fact_claims": _sql("select * from fact", *_TO_FACT),
    "dq_duplicate_grain": _sql(
        """select claim_id, member_id, admission_date, service_line_number, count(*) as "count" from clean
        group by all having count(*) > 1""", *_TO_CLEAN),
    "duplicate_claims": _sql(
        'select claim_id, count(*) as "count" from clean group by claim_id having count(*) > 1', *_TO_CLEAN),
    "dedupe_claims": _sql(
        """select * from clean qualify row_number() over (
          partition by plan_id, member_id, claim_id, service_line_number, admission_date
          order by discharge_date nulls first, provider_id nulls first, pharmacy_id nulls first,
            procedure_code nulls first, diagnosis_code nulls first, revenue_code nulls first,
            place_of_service_std_id nulls first, claim_type nulls first, claim_status nulls first,
            line_charge nulls first, line_allowed nulls first, units nulls first) = 1""", *_TO_CLEAN),
    "mart_plan_month": _sql(
        """select plan_key, strftime(admission_date, '%Y-%m') as year_month,
          count(distinct claim_id) as claims_cnt,
          cast(sum(line_allowed) as decimal(28,2)) as paid_amount,
          cast(sum(line_charge) as decimal(28,2)) as billed_amount
        from fact group by 1, 2""", *_TO_FACT),
    "bi_fact_claims_enriched": _sql("select * from wide", *_TO_FACT, _ALL_DIMS, _WIDE),
    "pos_first_code": f"""
      select regexp_extract(Place_of_Service_Code, '[0-9]+') as code, count(*) as n
      from ({_LOOKUPS['places']}) p where Place_of_Service_Code is not null group by 1""",
    "code_list": "select trim(' ' || p_brand || ' ', ' ') as code from part where p_size <> 7",
    "age_years": f"""
      select o_orderkey, cast(floor(date_diff('day', cast(o_orderdate as date), date '{AS_OF}') / 365)
        as int) as age from orders""",
    "length_of_stay": _sql(
        """select claim_id, service_line_number, admission_date, discharge_date,
          cast(discharge_date - admission_date as int) as days,
          cast(admission_date + 31 as date) as limit_of_stay
        from clean""", *_TO_CLEAN),
    "allowed_amount": """
      select l_orderkey, l_linenumber, cast(round(cast(l_extendedprice as decimal(18,2))
        * (1 - cast(l_discount as decimal(4,2))), 2) as decimal(18,2)) as allowed from lineitem""",
    "recent_events": """
      select event_id, ts, user_id from events where event_type = 'error'
      order by ts desc, event_id limit 50""",
    "reconcile_counts": _sql(
        """select count(*) as rows_read, count(*) filter (not bad) as rows_written,
          count(*) filter (bad) as rows_rejected, count(admission_date) as admission_dates,
          count(line_charge) as line_charges, count(units) as unit_counts from typed""", *_TO_TYPED),
    "kpi_totals": _sql(f"select {_FIGURES} from ruled", *_TO_RULED),
    "kpi_utilization_trend": _sql(
        f"select strftime(admission_date, '%Y-%m') as year_month, {_FIGURES} from ruled group by 1",
        *_TO_RULED),
    "kpi_diagnosis_dist": _sql(
        """select diagnosis_code as code, count(*) as claim_lines,
          round(count(*)::double / (select count(*) from clean), 6) as share
        from clean group by 1""", *_TO_CLEAN),
    "kpi_procedure_dist": _sql(
        """select procedure_code as code, count(*) as claim_lines,
          round(count(*)::double / (select count(*) from clean), 6) as share
        from clean group by 1""", *_TO_CLEAN),
    "kpi_top_procedures": _sql(
        """select procedure_code as code, count(*) as claim_lines,
          round(count(*)::double / (select count(*) from clean), 6) as share
        from clean group by 1 order by claim_lines desc, code limit 20""", *_TO_CLEAN),
    "kpi_unmatched_codes": _sql(
        """select case when diagnosis_code > 'BRAND#3' then diagnosis_code end as code, count(*) as claim_lines,
          round(count(*)::double / (select count(*) from clean), 6) as share
        from clean group by 1""", *_TO_CLEAN),
    "run_columns": """
      select s_suppkey, 'run-1' as run_id, 'supplier.csv' as source_file from supplier""",
    "keyless_rejects": """
      select count(*) as clean_rows, cast(0 as bigint) as rejects from lineitem""",
    "normalized_headers": """
      select n_nationkey as place_of_service_code_s, n_name as name_of_it from nation""",
    "validation_report": """
      select 'events' as "table", true as "exists", count(*) as rows,
        count(*) filter (cast(cast(ts as date) as varchar) = '1995-01-01') as rows_this_run from events
      union all select 'nation', true, count(*), null from nation
      union all select 'nothing', false, 0, null""",
    "dq_issue_rows": _sql(
        """select 'run-1' as gold_run_id, 'DUPLICATE_GRAIN' as issue_type, 'fact_claims' as table_name,
          count(*) as record_count
        from (select 1 from clean group by claim_id, member_id, admission_date, service_line_number
          having count(*) > 1)""", *_TO_CLEAN),
    "widened_batches": """
      select s_suppkey as id, 'r1' as run_id, null as segment from supplier
      union all select c_custkey, 'r2', c_mktsegment from customer""",
    "log_review": """
      select 'run-' || event_id as run_id, 'gold' as layer, 'user-' || user_id as target,
        case when event_id % 2 = 0 then 'SUCCESS' else 'FAILED' end as status, event_id as rows_read
      from events where event_type = 'error' order by ts desc, 'run-' || event_id limit 50""",
    "widened_types": """
      select cast(l_orderkey as bigint) as id, cast(l_linenumber as int) as line, cast(cast(l_extendedprice as decimal(18,2)) as decimal(16,6)) as amount,
        cast(l_partkey as double) as part, 'r1' as run_id from lineitem where l_linenumber <= 2
      union all select l_orderkey + 5000000000, l_linenumber + 100000, cast(cast(l_extendedprice as decimal(18,2)) / 8 as decimal(16,6)),
        l_partkey + cast(0.1 as double), 'r2' from lineitem where l_linenumber in (3, 4)
      union all select l_orderkey, l_linenumber, cast(cast(cast(l_extendedprice as decimal(18,2)) as decimal(8,1)) as decimal(16,6)),
        cast(l_partkey as double), 'r3' from lineitem where l_linenumber > 4""",
    "wide_by_buckets": _sql("select * from wide", *_TO_FACT, _ALL_DIMS, _WIDE),
    "mart_after_correction": _sql(
        """select plan_key, strftime(admission_date, '%Y-%m') as year_month,
          count(distinct claim_id) as claims_cnt,
          cast(sum(line_allowed) as decimal(28,2)) as paid_amount,
          cast(sum(line_charge + case when year(admission_date) = 1995 then 1 else 0 end) as decimal(28,2)) as billed_amount
        from fact group by 1, 2""", *_TO_FACT),
    "mart_by_batches": _sql(
        """select plan_key, strftime(admission_date, '%Y-%m') as year_month,
          count(distinct claim_id) as claims_cnt,
          cast(sum(line_allowed) as decimal(28,2)) as paid_amount,
          cast(sum(line_charge + case when discharge_date >= date '1995-07-01' then 1 else 0 end) as decimal(28,2)) as billed_amount
        from fact group by 1, 2""", *_TO_FACT),
    "calendar_bounds": _sql(
        """select date_diff('day', min(d), max(d)) + 1 as days, min(d) as first, max(d) as last,
          (select count(*) from clean where service_line_number = '7') as outside
        from (select admission_date as d from clean where service_line_number <> '7')""", *_TO_CLEAN),
    "unpadded_dates": """
      select o_orderkey, cast(o_orderdate as date) as service_date from orders""",
    "fact_by_line_id": _sql(
        """select claim_id, sha256(claim_id || '/' || service_line_number) as claim_fact_key,
          sha256('H' || plan_id) as plan_key from clean""", *_TO_CLEAN),
    "impute_counts": """
      select cast(l_orderkey as varchar) as claim_id, l_linenumber,
        cast(case when l_linenumber = 2 then 0 else l_linenumber end as integer) as units,
        cast(case when l_linenumber = 3 then 0 else 12 end as integer) as quantity,
        cast(case when l_linenumber > 4 then 0 else 30 end as integer) as days_supply,
        cast(l_linenumber = 2 as integer) as units_imputed_flag,
        cast(l_linenumber = 3 as integer) as quantity_imputed_flag,
        cast(l_linenumber > 4 as integer) as days_supply_imputed_flag
      from lineitem""",
    "kpi_provider": _sql(
        f"""select f.*, provider_id, provider_specialty,
          round(total_allowed::double / nullif(total_charge, 0)::double, 6) as allowed_ratio
        from (select provider_key, {_FIGURES} from fact group by 1) f
        left join dim_providers pr on f.provider_key = pr.provider_key""", *_TO_FACT, _ALL_DIMS),
    "kpi_claim_type": _sql(f"select claim_type, {_FIGURES} from ruled group by 1", *_TO_RULED),
    "kpi_claim_status": _sql(f"select claim_status, {_FIGURES} from ruled group by 1", *_TO_RULED),
}
