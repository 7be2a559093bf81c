"""DuckDB SQL for each query, written independently of the Spark plans.

Every statement is a chain of named steps; a step lists the steps it reads, and ``statement``
puts the needed ones in front.
"""

from __future__ import annotations

import re

from rosterweave.config import (
    DEPARTMENTS,
    EMAIL_PATTERN,
    LEGACY_DEPARTMENT_CODES,
)
from workload.fixtures import FIXTURES

REPORT_DATE = "date '2002-01-01'"
A, B = "'GlobalTech_HRIS'", "'AcquiredCo_HRIS'"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def emp_id(c: str, prefix: str) -> str:
    digits = rf"regexp_extract({c}, '(\d+)$', 1)"
    return (
        f"{prefix} || '-' || case when {digits} = '' then {c} "
        f"else lpad(ltrim({digits}, '0'), greatest(6, length(ltrim({digits}, '0')))::int, '0') end"
    )


def manager(c: str) -> str:
    prefix = f"case when upper({strip(c)}) like 'ACQ%' then 'AC' else 'GT' end"
    return (
        f"case when {c} is null or {strip(c)} in ('', 'nan') then '' "
        rf"when not regexp_matches({strip(c)}, '\d$') then {strip(c)} "
        f"else {emp_id(strip(c), prefix)} end"
    )


def date(c: str) -> str:
    layouts = [
        (r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"),
        (r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"),
        (r"\d{1,2}-[A-Za-z]{3}-\d{4}", "%d-%b-%Y"),
    ]
    return "coalesce(" + ", ".join(
        f"case when regexp_full_match({c}, '{p}') then try_strptime({c}, '{f}')::date end"
        for p, f in layouts
    ) + ")"


def name_case(c: str) -> str:
    def capital(t: str) -> str:
        return f"case when {t} = 'ß' then 'Ss' else upper({t}) end"

    return f"""array_to_string(list_transform(regexp_extract_all({c}, '[ \\-'']|[^ \\-'']+'), lambda t: case
        when lower(t) like 'mc%' and length(t) > 2
          then 'Mc' || {capital('substr(t, 3, 1)')} || lower(substr(t, 4))
        when lower(t) like 'mac%' and length(t) > 3
          then 'Mac' || {capital('substr(t, 4, 1)')} || lower(substr(t, 5))
        else {capital('substr(t, 1, 1)')} || lower(substr(t, 2)) end), '')"""


def lcs(a: str, b: str) -> str:
    zeros = f"list_transform(range(0, length({b}) + 1), lambda i: 0)"
    return f"""list_reduce(
        list_prepend({{'r': {zeros}, 'c': ''}},
          list_transform(string_split({a}, ''), lambda ch: {{'r': {zeros}, 'c': ch}})),
        lambda p, x: {{'r': list_transform(range(1, length({b}) + 2), lambda j:
            list_max(list_transform(range(1, j + 1), lambda k:
              case when k > 1 and substr({b}, (k - 1)::int, 1) = x.c then p.r[k - 1] + 1
                else p.r[k] end))), 'c': ''}}
      ).r[length({b}) + 1]"""


def token_sorted(c: str) -> str:
    return rf"array_to_string(list_sort(string_split_regex(trim({c}), '\s+')), ' ')"


def values_list(pairs: dict[str, str]) -> str:
    return ", ".join(f"('{k}', '{v}')" for k, v in pairs.items())


DEPARTMENT_ROWS = values_list({d: d for d in DEPARTMENTS} | LEGACY_DEPARTMENT_CODES)
STANDARD = (
    "employee_id, source_system, first_name, last_name, email, department, job_title, hire_date, "
    "country, employment_type, employment_status, manager_id"
)
EMPLOYEE = f"ingest_ordinal, {STANDARD}, first_name_raw, last_name_raw, employee_id_raw"
TYPES = "('Full-Time', 'Part-Time', 'Contractor')"
STATUSES = "('Active', 'Inactive', 'On Leave')"
STRIPPED = [
    "employee_id", "first_name", "last_name", "email", "department", "job_title", "hire_date",
    "country", "employment_type", "employment_status", "manager_id",
]

STEPS: dict[str, str] = {
    **{name: sql for name, sql in FIXTURES.items()},
    "aligned": f"""
      select ingest_ordinal, employee_id, {A} as source_system, first_name, last_name, email,
        department, job_title, hire_date, country, employment_type, 'Active' as employment_status,
        regexp_replace(coalesce(manager_id, ''), '\\.0$', '') as manager_id
      from fx_hris_a
      union all
      select ingest_ordinal, employee_identifier, {B}, first_name, last_name, email, department,
        role, case when regexp_full_match(hire_timestamp, '\\d{{1,2}}-[A-Za-z]{{3}}-\\d{{4}}')
          then hire_timestamp else left(hire_timestamp, 10) end, location,
        case employment_type when 'FT' then 'Full-Time' when 'PT' then 'Part-Time'
          when 'CONTRACTOR' then 'Contractor' else employment_type end,
        employment_status, coalesce(manager_employee_id, '')
      from fx_hris_b""",
    "stripped": "select ingest_ordinal, source_system, "
    + ", ".join(f"{strip(c)} as {c}" for c in STRIPPED)
    + " from aligned",
    "departments": f"select * from (values {DEPARTMENT_ROWS}) d(code, canonical)",
    "emp": f"""
      select ingest_ordinal,
        {emp_id('employee_id', f"case source_system when {A} then 'GT' when {B} then 'AC' else 'XX' end")}
          as employee_id,
        source_system, {name_case("nfc_normalize(first_name)")} as first_name,
        {name_case("nfc_normalize(last_name)")} as last_name, email,
        coalesce(canonical, department) as department, job_title,
        coalesce({date('hire_date')}, {date('left(hire_date, 10)')}) as hire_date, country,
        employment_type, employment_status, {manager('manager_id')} as manager_id,
        first_name as first_name_raw, last_name as last_name_raw, employee_id as employee_id_raw,
        department as department_in
      from stripped left join departments on department = code""",
    "pay_all": f"""
      select ingest_ordinal,
        {emp_id('employee_id', "case source when 'GlobalTech' then 'GT' when 'AcquiredCo' then 'AC' else 'XX' end")}
          as employee_id, source, base_salary as salary_in,
        try_cast({strip("regexp_replace(base_salary, '[$£€,]', '', 'g')")} as double) as base_salary,
        currency, pay_frequency, {date('effective_date')} as effective_date
      from fx_payroll""",
    "pay_usd": """
      select *, base_salary * (case currency when 'USD' then 1.0 when 'EUR' then 1.08 end)::double
        as base_salary_usd
      from pay_all""",
    "pay_annual": """
      select *, base_salary_usd * (case pay_frequency when 'Annual' then 1 when 'Monthly' then 12
        when 'Bi-Weekly' then 26 end) as salary_usd_annual
      from pay_usd""",
    "pay": """
      select * exclude (rn, salary_in) from (select *, row_number() over (
          partition by employee_id, source
          order by effective_date desc nulls last, ingest_ordinal desc) as rn from pay_annual)
      where rn = 1""",
    "ben": f"""
      select ingest_ordinal, {emp_id('employee_id', "'GT'")} as employee_id, plan_type,
        coverage_level, {date('enrollment_date')} as enrollment_date, premium_employee,
        premium_employer
      from fx_benefits""",
    "ben_ranked": """
      select *, row_number() over (partition by employee_id, plan_type
        order by enrollment_date desc nulls last, ingest_ordinal desc, premium_employee desc,
          premium_employer desc, coverage_level desc) as rn
      from ben""",
    "emp_groups": """
      select *, count(*) over w as n,
        coalesce(min(first_name) over w = max(first_name) over w
          and min(last_name) over w = max(last_name) over w, false) as same_person,
        coalesce(contains(lower(first_name_raw), 'dup'), false) as marked
      from emp window w as (partition by employee_id)""",
    "emp_ranked": """
      select *, row_number() over (partition by employee_id
        order by case when same_person then 0 else marked::int end, ingest_ordinal) as rn
      from emp_groups""",
    "pass1": f"""
      select *, case when contains(source_systems, ',') then 'exact_id' else 'single_source' end
        as dedup_method
      from (select {EMPLOYEE},
          concat_ws(',', case when employee_id in (select employee_id from ben) then 'benefits' end,
            case when source_system < 'P' and lower(source_system) < 'payroll'
              then replace(replace(lower(source_system), ' ', '_'), '-', '_') end,
            case when employee_id in (select employee_id from pay) then 'payroll' end)
            as source_systems
        from emp_ranked where rn = 1)""",
    "shared_emails": """
      select email from pass1 where email is not null group by email
      having count(distinct source_system) > 1""",
    "pass2": f"""
      select {EMPLOYEE}, source_systems,
        case when email in (select email from shared_emails) then 'email_match' else dedup_method end
          as dedup_method
      from pass1
      where not (source_system = {B} and email in (select email from shared_emails))""",
    "sides": f"""
      select *, {token_sorted('full_name')} as name_key
      from (select *, first_name || ' ' || last_name as full_name from pass2)
      where full_name is not null and hire_date is not null""",
    "near": f"""
      select a.name_key as a_key, b.name_key as b_key, b.employee_id as acq_employee_id,
        a.employee_id as gt_employee_id, b.full_name as acq_full_name, a.full_name as gt_full_name,
        b.hire_date as acq_hire_date, a.hire_date as gt_hire_date,
        abs(date_diff('day', a.hire_date, b.hire_date)) as hire_date_delta_days,
        b.email as acq_email, a.email as gt_email, b.country as acq_country,
        a.country as gt_country
      from sides a join sides b on a.hire_date between b.hire_date - 30 and b.hire_date + 30
      where a.source_system = {A} and b.source_system = {B}""",
    "scored": f"""
      select a_key, b_key, length(a_key) + length(b_key) as lengths, {lcs('a_key', 'b_key')} as lcs
      from (select distinct a_key, b_key from near)""",
    "pairs": """
      select acq_employee_id, gt_employee_id, acq_full_name, gt_full_name,
        200.0::double * lcs / lengths as match_score, acq_hire_date, gt_hire_date,
        hire_date_delta_days, acq_email, gt_email, acq_country, gt_country
      from near join scored using (a_key, b_key) where 200 * lcs >= 88 * lengths""",
    "final": f"""
      select {EMPLOYEE}, source_systems,
        case when employee_id in (select acq_employee_id from pairs) then 'fuzzy_name'
          else dedup_method end as dedup_method
      from pass2""",
    "ghost_rows": "select * from pay where employee_id not in (select employee_id from pass2)",
    "manager_use": "select manager_id, count(*) as n from final where trim(manager_id) <> '' group by 1",
}


def _count_check(number: int, check: str, text: str, source: str, total: str, passed: str) -> str:
    return (
        f"select {number} as check_no, '{check}' as \"check\", '{text}' as description, "
        f"count(*) filter ({total}) as total, count(*) filter ({total} and {passed}) as passed "
        f"from {source}"
    )


def _present(c: str) -> str:
    return f"({c} is not null and trim({c}) <> '')"


_CHECKS = [
    _count_check(i, f"not_null.{c}", f"{c} must not be null or blank", "final", "true", _present(c))
    for i, c in enumerate(
        ("employee_id", "first_name", "last_name", "email", "department", "country"), start=1
    )
]
for _number, _column in ((7, "employee_id"), (8, "email")):
    _CHECKS.append(
        f"select {_number}, 'unique.{_column}', "
        f"'{_column} must be unique across all records (post-dedup)', count(*), "
        f"count(distinct {_column}) + max(({_column} is null)::int) from final"
    )
_CHECKS += [
    _count_check(
        9, "values_in_set.employment_type",
        "employment_type must be one of: Contractor, Full-Time, Part-Time", "final",
        _present("employment_type"), f"employment_type in {TYPES}",
    ),
    _count_check(
        10, "values_in_set.currency", "currency must be one of: EUR, GBP, USD", "pay",
        _present("currency"), "currency in ('USD', 'EUR', 'GBP')",
    ),
    _count_check(
        11, "regex.email", "email must match valid RFC-style address format", "final",
        _present("email"), f"regexp_matches(email, '{EMAIL_PATTERN}')",
    ),
    _count_check(
        12, "regex.employee_id", r"employee_id must match GT-\d{6} or AC-\d{6}", "final",
        _present("employee_id"), r"regexp_matches(employee_id, '^(GT|AC)-\d{6}$')",
    ),
    _count_check(
        13, "numeric_range.salary_usd_annual",
        "salary_usd_annual must be between 15,000 and 2,000,000", "pay",
        "salary_usd_annual is not null", "salary_usd_annual between 15000 and 2000000",
    ),
    _count_check(
        14, "date_range.hire_date", "hire_date must be between 1970-01-01 and 2002-01-01", "final",
        "hire_date is not null", f"hire_date between date '1970-01-01' and {REPORT_DATE}",
    ),
    "select 15, 'referential_integrity.manager_id', "
    "'Every non-blank manager_id must exist as an employee_id', sum(n)::bigint, "
    "coalesce(sum(n) filter (manager_id in (select employee_id from final)), 0)::bigint "
    "from manager_use",
]
STEPS["checks"] = """
      select check_no::bigint as check_no, "check", description, total::bigint as total,
        passed::bigint as passed, (total - passed)::bigint as failed,
        case when total = 0 then 0.0::double else round_even(passed::double / total, 6) end
          as pass_rate,
        case when total = passed then 'PASS' else 'FAIL' end as status
      from (""" + " union all ".join(_CHECKS) + ")"


def _counter_rows(source: str, table: str, counters: dict[str, str], always: set[str]) -> str:
    """(source, counter, value) rows; a counter is listed if positive, or always."""
    aggregates = ", ".join(f"{sql} as \"{name}\"" for name, sql in counters.items())
    rows = " union all ".join(
        f"select '{source}' as source, '{name}' as counter, \"{name}\"::bigint as value from c"
        + ("" if name in always else f" where \"{name}\" > 0")
        for name in counters
    )
    return f"select * from (with c as (select {aggregates} from {table}) {rows})"


def _where(condition: str) -> str:
    return f"count(*) filter ({condition})"


_EMAIL_OK = f"coalesce(regexp_matches(email, '{EMAIL_PATTERN}'), false)"
STEPS["emp_counters"] = _counter_rows(
    "clean_employees",
    "emp",
    {
        "input_rows": "count(*)",
        "output_rows": "count(*)",
        "rows_dropped": "0",
        "whitespace_stripped_cells": "(select "
        + " + ".join(_where(f"{c} <> {strip(c)}") for c in STRIPPED)
        + " from aligned)",
        "names_normalized": _where("first_name <> first_name_raw")
        + " + "
        + _where("last_name <> last_name_raw"),
        "employee_ids_namespaced": "count(*)",
        "departments_mapped": _where("department_in in (select code from departments)"),
        "hire_date_parsed": "case when count(*) = count(hire_date) then count(*) else -1 end",
        "unmapped_department": _where("department_in not in (select code from departments)"),
        "null_department": _where("department is null"),
        "null_country": _where("country is null"),
        "invalid_email": _where(f"not {_EMAIL_OK}"),
        "invalid_employment_type": _where(f"employment_type not in {TYPES}"),
        "invalid_employment_status": _where(f"employment_status not in {STATUSES}"),
        "unparseable_hire_date": _where("hire_date is null"),
        "implausible_hire_date": _where(
            f"hire_date < date '1970-01-01' or hire_date > {REPORT_DATE}"
        ),
    },
    {"input_rows", "output_rows", "rows_dropped", "employee_ids_namespaced", "departments_mapped"},
)
STEPS["pay_counters"] = _counter_rows(
    "clean_payroll",
    "pay_annual",
    {
        "input_rows": "count(*)",
        "output_rows": "(select count(*) from pay)",
        "rows_dropped": "count(*) - (select count(*) from pay)",
        "salary_symbols_stripped": _where(
            "try_cast(salary_in as double) is null and base_salary is not null"
        ),
        "payroll_ids_namespaced": "count(*)",
        "salary_converted_to_usd": "case when "
        + _where("base_salary is not null and base_salary_usd is null")
        + " = 0 then count(base_salary_usd) else -1 end",
        "salary_usd_annual_computed": "case when "
        + _where("pay_frequency not in ('Annual', 'Monthly', 'Bi-Weekly')")
        + " = 0 then count(salary_usd_annual) else -1 end",
        "effective_date_parsed": "case when count(*) = count(effective_date) then count(*) else -1 end",
        "payroll_duplicates_removed": "count(*) - (select count(*) from pay)",
        "unparseable_salary": _where("base_salary is null"),
        "non_positive_salary": _where("base_salary <= 0"),
        "invalid_currency": _where("currency not in ('USD', 'EUR', 'GBP')"),
        "missing_fx_rate": _where("base_salary is not null and base_salary_usd is null"),
        "unmapped_pay_frequency": _where("pay_frequency not in ('Annual', 'Monthly', 'Bi-Weekly')"),
        "unparseable_effective_date": _where("effective_date is null"),
    },
    {"input_rows", "output_rows", "rows_dropped", "payroll_ids_namespaced"},
)
STEPS["ben_counters"] = _counter_rows(
    "clean_benefits",
    "ben",
    {
        "input_rows": "count(*)",
        "output_rows": "count(*)",
        "rows_dropped": "0",
        "benefits_ids_namespaced": "count(*)",
        "enrollment_date_parsed": "case when count(*) = count(enrollment_date) then count(*) else -1 end",
        "unparseable_enrollment_date": _where("enrollment_date is null"),
        "negative_premium_employee": _where("premium_employee < 0"),
        "negative_premium_employer": _where("premium_employer < 0"),
    },
    {"input_rows", "output_rows", "rows_dropped", "benefits_ids_namespaced"},
)

# --- source parsing ----------------------------------------------------------------------------

STEPS["staff_json"] = """
      select *, (ingest_ordinal % 1000) % 11 as k, (ingest_ordinal % 1000) % 2 as odd from fx_hris_b"""
STEPS["staff_errors"] = """
      select *, case k when 3 then 'Missing field: ''employee_identifier'''
        when 5 then 'Missing field: ''name''' when 7 then 'Missing field: ''last''' end as error
      from staff_json"""
STEPS["enrollment_texts"] = """
      select ingest_ordinal, case when ingest_ordinal % 97 = 0 then '' else employee_id end
          as employee_id, plan_type,
        case when ingest_ordinal % 5 <> 0 then coverage_level else '' end as coverage_level,
        enrollment_date, premium_employee, premium_employer,
        case when ingest_ordinal % 79 = 0 then 'Element is not well-formed'
          when ingest_ordinal % 97 = 0 then 'empty employee_id'
          when ingest_ordinal % 89 = 0 then 'could not convert string to float: ''12x'''
          when ingest_ordinal % 83 = 0 then 'could not convert string to float: ''n/a''' end as error,
        '<enrollment><employee_id> ' || case when ingest_ordinal % 97 = 0 then ' ' else employee_id end
          || '</employee_id><plan_type>'
          || case when ingest_ordinal % 79 = 0 then 'A &bad; ' else plan_type end || '</plan_type>'
          || case when ingest_ordinal % 5 <> 0
            then '<coverage_level>' || coverage_level || '</coverage_level>' else '' end
          || case when ingest_ordinal % 97 = 0 then '<note>keep <b k="1">me</b></note>' else '' end
          || '<enrollment_date>' || enrollment_date || '</enrollment_date><premium_employee>'
          || case when ingest_ordinal % 89 = 0 then '12x' when ingest_ordinal % 7 = 0 then ''
            else premium_employee::decimal(18,2)::varchar end || '</premium_employee>'
          || case when ingest_ordinal % 83 = 0 then '<premium_employer>n/a</premium_employer>'
            when ingest_ordinal % 3 <> 0
            then '<premium_employer>' || premium_employer::decimal(18,2)::varchar || '</premium_employer>'
            else '' end || '</enrollment>' as raw_record
      from fx_benefits"""
STEPS["enrollments"] = """
      select ingest_ordinal, employee_id, plan_type, coverage_level, enrollment_date,
        case when ingest_ordinal % 7 = 0 then 0 else premium_employee::decimal(18,2)::double end
          as premium_employee,
        case when ingest_ordinal % 3 = 0 then 0 else premium_employer::decimal(18,2)::double end
          as premium_employer
      from enrollment_texts where error is null"""


def _csv_line(columns: list[str]) -> str:
    cells = [
        f"case when regexp_matches({c}, '[\",\\n]') then '\"' || replace({c}, '\"', '\"\"') || '\"' "
        f"else coalesce({c}, '') end"
        for c in columns
    ]
    return " || ',' || ".join(cells)


def _csv_damaged(table: str, spared: int, source: str, columns: list[str]) -> str:
    """Every record as a line of its page, and what is wrong with it."""
    n = "ingest_ordinal"
    width = len(columns)
    return f"""
      select *, {source} as source, case damage when 'open' then case when contains(line, '"')
            then 'Text behind a closing quote' else 'Quote is never closed' end
          when 'short' then 'Expected {width} cells, found {width - 1}'
          when 'surplus' then 'Expected {width} cells, found {width + 1}' end as error,
        case damage when 'open' then substr(line, 1, strpos(line, ',')) || '"'
            || substr(line, strpos(line, ',') + 1)
          when 'short' then regexp_replace(line, ',[^,]*$', '')
          when 'surplus' then line || ',more' else line end as raw_record
      from (select *,
          case when {n} % 10 = {spared} then 'none' when {n} % 101 = 3 then 'open'
            when {n} % 103 = 5 then 'short' when {n} % 107 = 7 then 'surplus' else 'none' end as damage,
          case when ({n} // 500) % 2 = 0 then {_csv_line(columns)}
            else {_csv_line(columns[::-1])} end as line
        from {table})"""


_STAFF_COLUMNS = [
    "employee_id", "first_name", "last_name", "email", "department", "job_title", "hire_date",
    "country", "employment_type", "manager_id",
]
_PAY_COLUMNS = [
    "employee_id", "source", "base_salary", "currency", "pay_frequency", "effective_date",
    "bonus_target_pct",
]
STEPS["staff_file"] = """
      select * replace (case when ingest_ordinal % 10 = 4
        then first_name || chr(10) || last_name else first_name end as first_name)
      from fx_hris_a"""
STEPS["pay_file"] = """
      select * replace (case when ingest_ordinal % 10 = 7 then 'a' || chr(10) || 'b ' || pay_frequency
        else pay_frequency end as pay_frequency), '2.5' as bonus_target_pct from fx_payroll"""
STEPS["staff_lines"] = _csv_damaged("staff_file", 4, A, _STAFF_COLUMNS)
STEPS["pay_lines"] = _csv_damaged("(select * rename (source as paid_by) from pay_file)", 7, "'Payroll_ADP'", [
    "paid_by" if c == "source" else c for c in _PAY_COLUMNS
])
_PAGE_COUNTS = "count(*) filter (error is null), count(*) filter (error is not null)"


def statement(query: str) -> str:
    """The query with the steps it needs in front, in order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", sql):
                visit(STEPS[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    steps = ",\n".join(f"{name} as ({STEPS[name]})" for name in needed)
    return f"with {steps}\n{query}" if needed else query


_DAYS = f"date_diff('day', hire_date, {REPORT_DATE})"
_SALARIES = f"""(select employment_type, salary_usd_annual as x from pay join pass2 using (employee_id)
  where employment_type in {TYPES} and salary_usd_annual is not null)"""
_DEPARTMENT = "coalesce(department, '(no department)')"

QUERIES: dict[str, str] = {
    "staff_json_records": """
      select employee_identifier, first_name, last_name, '' as full_name,
        case when k = 9 then null else email end as email, department, role, location,
        hire_timestamp, employment_type, employment_status,
        case when odd = 0 then manager_employee_id else '' end as manager_employee_id
      from staff_errors where error is null""",
    "staff_json_scan": """
      select employee_identifier, first_name, last_name, '' as full_name,
        case when k = 9 then null else email end as email, department, role, location,
        hire_timestamp, employment_type, employment_status,
        case when odd = 0 then manager_employee_id else '' end as manager_employee_id, form
      from staff_errors, (values ('pages'), ('lines')) f(form) where error is null""",
    "staff_json_dead_letters": f"""
      select {B} as source, error, location, hire_timestamp from staff_errors
      where error is not null""",
    "props_dead_letters": """
      select event_id, 'Missing field: ''k''' as error,
        '{"other":' || json_extract_string(props, '$.k') || '}' as raw_record
      from events where event_id % 7 = 0""",
    "enrollment_records": "select * from enrollments",
    "enrollment_dead_letters": """
      select 'Benefits_MedShield' as source, raw_record, error
      from enrollment_texts where error is not null""",
    "dead_letters_by_error": f"""
      select {B} as source, error, count(*) as count from staff_errors where error is not null
      group by error
      union all
      select 'Benefits_MedShield', error, count(*) from enrollment_texts where error is not null
      group by error""",
    "staff_csv_scan": f"select {', '.join(_STAFF_COLUMNS)} from staff_lines where error is null",
    "payroll_csv_scan": """
      select employee_id, paid_by as source, nullif(base_salary, 'n/a') as base_salary, currency,
        pay_frequency, 2.5::double as bonus_target_pct, effective_date
      from pay_lines where error is null""",
    "csv_dead_letters": """
      select source, error, raw_record from staff_lines where error is not null
      union all
      select source, error, raw_record from pay_lines where error is not null""",
    "ingest_report": f"""
      select {A} as source, 'lines' as unit, l as expected, l as accounted, r as rows_read,
        d as dead_letters, f as files, 0::bigint as files_off
      from (select {_PAGE_COUNTS}, sum(1 + length(raw_record) - length(replace(raw_record, chr(10), '')))::bigint,
        count(distinct ingest_ordinal // 500) from staff_lines) as t(r, d, l, f)
      union all
      select 'Payroll_ADP', 'lines', l, l, r, d, f, 0
      from (select {_PAGE_COUNTS}, sum(1 + length(raw_record) - length(replace(raw_record, chr(10), '')))::bigint,
        count(distinct ingest_ordinal // 500) from pay_lines) as t(r, d, l, f)
      union all
      select {B}, 'records', r + d, r + d, r, d, f, 0
      from (select {_PAGE_COUNTS}, count(distinct (ingest_ordinal - 1000000000) // 100)
        from staff_errors) as t(r, d, f)
      union all
      select 'Benefits_MedShield', 'records', r + d, r + d, r, d, f, 0
      from (select {_PAGE_COUNTS}, count(distinct ingest_ordinal // 10000) from enrollment_texts) as t(r, d, f)""",
    "enrollment_xml_scan": "select * exclude (ingest_ordinal) from enrollments",
    "payroll_repeated_ids": """
      select count(*) - count(distinct employee_id) - max((employee_id is null)::int)
        as repeated_rows, count(*) as total_rows from fx_payroll""",
    "align_staff": "select * from aligned",
    "unknown_codes": f"""
      select distinct employment_type, 'a' as company from fx_hris_a
      where employment_type not in {TYPES}
      union all
      select distinct employment_type, 'b' from fx_hris_b
      where employment_type is null or employment_type not in ('FT', 'PT', 'CONTRACTOR')""",
    "clean_names": """
      select ingest_ordinal, first_name, last_name, first_name_raw, last_name_raw from emp""",
    "name_case_words": f"""
      select word, {name_case("nfc_normalize(word)")} as name
      from (select distinct unnest(string_split_regex(text, '[^\\p{{L}}\\p{{M}}''-]+')) as word
        from documents) where word <> ''""",
    "namespace_ids": "select ingest_ordinal, employee_id, manager_id, employee_id_raw from emp",
    "parse_dates": """
      select 'staff' as kind, ingest_ordinal, hire_date as parsed from emp
      where ingest_ordinal < 1000000000
      union all
      select 'payroll', ingest_ordinal, effective_date from pay_all""",
    "payroll_usd_annual": """
      select ingest_ordinal, employee_id, base_salary, base_salary_usd, salary_usd_annual
      from pay_annual""",
    "payroll_usd_annual_with_gbp": """
      select ingest_ordinal, usd as base_salary_usd, usd * (case pay_frequency when 'Annual' then 1
          when 'Monthly' then 12 when 'Bi-Weekly' then 26 end) as salary_usd_annual
      from (select *, base_salary * (case currency when 'USD' then 1.0 when 'EUR' then 1.08
          when 'GBP' then 1.27 end)::double as usd from pay_all)""",
    "map_departments": "select ingest_ordinal, department from emp",
    "unmapped_departments": """
      select department_in as department, count(*) as rows from emp
      where department_in not in (select code from departments) group by 1""",
    "nulls_by_source": """
      select source_system, count(*) as rows, 'department' as "column" from emp
      where department is null group by 1
      union all
      select source_system, count(*), 'country' from emp where country is null group by 1""",
    "unlisted_currencies": """
      select currency, count(*) as rows from fx_payroll
      where currency not in ('USD', 'EUR', 'GBP') group by 1""",
    "clean_reports": """
      select * from emp_counters union all select * from pay_counters
      union all select * from ben_counters""",
    "payroll_latest": "select * from pay",
    "benefits_current": "select * exclude (rn) from ben_ranked where rn = 1",
    "benefits_history": "select * exclude (rn) from ben_ranked where rn > 1",
    "pass1_resolved": "select * from pass1",
    "pass1_quarantine": f"""
      select {EMPLOYEE}, 'ID_COLLISION' as quarantine_reason from emp_ranked
      where rn > 1 and not same_person""",
    "pass2_resolved": "select * from pass2",
    "pass2_quarantine": f"""
      select *, 'EMAIL_MATCH_CROSS_COMPANY' as quarantine_reason from pass1
      where source_system = {B} and email in (select email from shared_emails)""",
    "fuzzy_pairs": "select * replace (round(match_score, 6) as match_score) from pairs",
    "fuzzy_flagged": "select employee_id, dedup_method from final",
    "probable_match_review": """
      select acq_employee_id as record_1_id, acq_full_name as record_1_name,
        acq_hire_date as record_1_hire_date, acq_email as record_1_email,
        gt_employee_id as record_2_id, gt_full_name as record_2_name,
        gt_hire_date as record_2_hire_date, gt_email as record_2_email,
        round_even(match_score, 2) as similarity_score,
        hire_date_delta_days as hire_date_diff_days,
        case when match_score >= 95 then 'CONFIRM_MERGE' when match_score >= 88
          then 'MANUAL_REVIEW' else 'REJECT' end as recommended_action
      from pairs""",
    "ghosts": "select *, true as ghost_employee from ghost_rows",
    "ghost_report": """
      select employee_id as payroll_employee_id, 'Unknown — no HRIS record' as name,
        round_even(salary_usd_annual, 2) as salary_usd_annual,
        'Payroll record (source: ' || source || ') has no matching employee_id in HRIS'
          as ghost_flag_reason
      from ghost_rows""",
    "unpaid_employees": """
      select distinct employee_id from pass2
      where employee_id not in (select employee_id from pay)""",
    "value_counts": """
      select 'dedup_method' as "column", dedup_method as value, count(*) as rows from final
      group by 2
      union all select 'source_systems', source_systems, count(*) from final group by 2""",
    "dedup_reports": """
      select pass_name, counter, value::bigint as value from (
        select 'pass1_exact_id' as pass_name, unnest(['input_rows', 'output_rows', 'rows_removed',
            'rows_quarantined', 'intra_hris_same_person_removed',
            'intra_hris_id_collision_quarantined', 'multi_source_employees']) as counter,
          unnest([i, o, s, q, s, q, m]) as value
        from (select (select count(*) from emp) as i, (select count(*) from pass1) as o,
          (select count(*) from emp_ranked where rn > 1 and same_person) as s,
          (select count(*) from emp_ranked where rn > 1 and not same_person) as q,
          (select count(*) from pass1 where contains(source_systems, ',')) as m)
        union all
        select 'pass2_email_match', unnest(['input_rows', 'output_rows', 'rows_removed',
            'rows_quarantined', 'cross_company_email_matches', 'acqco_rows_removed']),
          unnest([i, o, i - o, i - o, c, i - o])
        from (select (select count(*) from pass1) as i, (select count(*) from pass2) as o,
          (select count(*) from shared_emails) as c)
        union all
        select 'pass3_fuzzy_name', unnest(['input_rows', 'output_rows', 'rows_removed',
            'rows_quarantined', 'total_comparisons', 'probable_match_pairs', 'acqco_rows_flagged',
            'fuzzy_threshold', 'date_window_days']),
          unnest([i, i, 0, 0, t, p, f, 88, 30])
        from (select (select count(*) from pass2) as i, (select count(*) from near) as t,
          (select count(*) from pairs) as p,
          (select count(distinct acq_employee_id) from pairs) as f)
        union all
        select 'ghost_employee_detection', unnest(['input_rows', 'output_rows', 'rows_removed',
            'rows_quarantined', 'ghost_employees_detected', 'hris_employees_not_in_payroll']),
          unnest([i, i - g, 0, g, g, u])
        from (select (select count(*) from pay) as i, (select count(*) from ghost_rows) as g,
          (select count(distinct employee_id) from pass2
            where employee_id not in (select employee_id from pay)) as u))""",
    "dq_report": "select * from checks",
    "dq_summary": """
      select checks_run, passed, failed, round_even(passed::double / checks_run, 6) as pass_rate,
        failed <= 2 as gate_passed,
        case when failed <= 2 then 'PASSED (' || failed || ' failure' ||
            case when failed = 1 then '' else 's' end || ', threshold 2)'
          else 'FAILED — PIPELINE HALTED (' || failed || ' failures, threshold 2)' end as gate
      from (select count(*) as checks_run, count(*) filter (status = 'PASS') as passed,
        count(*) filter (status = 'FAIL') as failed from checks)""",
    "dq_check_bars": """
      select check_no, "check", passed::double as passed, failed::double as failed,
        case when failed = 0 then 0.5::double else failed::double end as failed_bar, status
      from checks""",
    "orphan_managers": """
      select manager_id, count(*) as rows from pass2
      where manager_id <> '' and manager_id not in (select employee_id from pass2) group by 1""",
    "headcount_department": f"""
      select {_DEPARTMENT} as department, count(employee_id) as headcount from pass2 group by 1""",
    "headcount_country_top20": """
      select country, count(*) as headcount from pass2 where country is not null
      group by 1 order by 2 desc, 1 limit 20""",
    "headcount_company": f"""
      select count(*) as employees, count(*) filter (source_system = {A}) as company_a,
        count(*) filter (source_system = {B}) as company_b from pass2""",
    "salary_distribution": f"""
      select employment_type, count(*) as n, round(min(x), 4) as min, round(max(x), 4) as max,
        round(quantile_cont(x, 0.25), 4) as q1, round(quantile_cont(x, 0.5), 4) as median,
        round(quantile_cont(x, 0.75), 4) as q3
      from {_SALARIES} group by 1""",
    "salary_matched_total": """
      select count(*) as matched_records from pay join pass2 using (employee_id)
      where employment_type is not null and salary_usd_annual is not null""",
    "salary_histogram": f"""
      select employment_type, floor(log10(x) / 0.1::double)::bigint as bin, count(*) as rows
      from {_SALARIES} where x > 0 group by 1, 2""",
    "tenure_stats": f"""
      select count(*) as n, round(min(t), 6) as min_years, round(max(t), 6) as max_years,
        round(avg(t), 6) as mean_years, round(median(t), 6) as median_years,
        round(stddev_samp(t), 6) as std_years
      from (select {_DAYS} / 365.25::double as t from pass2 where {_DAYS} >= 0)""",
    "tenure_histogram": f"""
      select i as bin, round(lo + i * w, 6) as from_years, round(lo + (i + 1) * w, 6) as to_years,
        (select count(*) from pass2 where {_DAYS} >= 0
          and least((({_DAYS}) - dlo) * 35 // (dhi - dlo), 34) = i) as employees
      from (select unnest(range(0, 35)) as i, dlo, dhi, dlo / 365.25::double as lo,
          (dhi - dlo) / 365.25::double / 35 as w
        from (select min({_DAYS}) as dlo, max({_DAYS}) as dhi from pass2 where {_DAYS} >= 0))""",
    "enrollment_rate": f"""
      select coalesce(h.department, e.department, '(no department)') as department,
        coalesce(enrolled, 0) as enrolled, coalesce(headcount, 0) as headcount,
        round(coalesce(enrolled / headcount::double * 100, 0), 6) as rate_percent,
        coalesce(enrolled / headcount::double * 100, 0) >= 50 as at_least_half
      from (select department, count(employee_id) as headcount from pass2
          where source_system = {A} group by 1) h
        full join (select a.department, count(distinct b.employee_id) as enrolled
          from ben b left join (select employee_id, department from pass2
            where source_system = {A}) a using (employee_id) group by 1) e
        on h.department is not distinct from e.department""",
    "golden_employees": f"""
      select {STANDARD}, first_name_raw, last_name_raw, source_systems, dedup_method,
        case source_system when {A} then 'GlobalTech' when {B} then 'AcquiredCo'
          else 'Unknown' end as company_origin,
        first_name || ' ' || last_name as full_name,
        round_even({_DAYS} / 365.25::double, 2) as tenure_years
      from final""",
    "golden_company_rows": f"""
      select employee_id, hire_date, 'AcquiredCo' as company_origin from final
      where source_system = {B}""",
    "rows_per_company": f"""
      select case source_system when {A} then 'GlobalTech' when {B} then 'AcquiredCo' end
        as company_origin, count(*) as rows from pass2 group by 1""",
}

STEPS["golden"] = QUERIES["golden_employees"]
_STAMPED = "select * replace (hire_date::timestamp as hire_date) from golden"
_COLUMNS = [
    *STANDARD.split(", "), "first_name_raw", "last_name_raw", "source_systems", "dedup_method",
    "company_origin", "full_name", "tenure_years",
]
_NEVER_NULL = ["employee_id", "source_system", "source_systems", "dedup_method", "company_origin"]
_KINDS = {"hire_date": "timestamp[ns]", "tenure_years": "double"}
_FIGURES = {
    "headcount_company": "headcount_company", "headcount_department": "headcount_department",
    "headcount_country": "headcount_country_top20", "salary_distribution": "salary_distribution",
    "salary_matched_total": "salary_matched_total",
    "salary_histogram": "salary_histogram", "tenure_stats": "tenure_stats",
    "tenure_histogram": "tenure_histogram", "enrollment_rate": "enrollment_rate",
    "check_bars": "dq_check_bars",
}
QUERIES |= {
    "integrate_id_quarantine": f"select * exclude (ingest_ordinal) from ({QUERIES['pass1_quarantine']})",
    "integrate_email_quarantine": f"select * exclude (ingest_ordinal) from ({QUERIES['pass2_quarantine']})",
    "integrate_benefits": f"select * exclude (ingest_ordinal) from ({QUERIES['benefits_current']})",
    "integrate_benefits_history": f"select * exclude (ingest_ordinal) from ({QUERIES['benefits_history']})",
    "integrate_clean_reports": QUERIES["clean_reports"],
    "integrate_pass_reports": QUERIES["dedup_reports"],
    "integrate_validation": "select * exclude (check_no) from checks",
    "integrate_ghosts": QUERIES["ghost_report"],
    "integrate_ingest_report": f"""
      select {A} as source, 'lines' as unit, n as expected, n as accounted, n as rows_read,
        0::bigint as dead_letters, f as files, 0::bigint as files_off
      from (select count(*), count(distinct ingest_ordinal // 500) from fx_hris_a) as t(n, f)
      union all
      select 'Payroll_ADP', 'lines', n, n, n, 0, f, 0
      from (select count(*), count(distinct ingest_ordinal // 5000) from fx_payroll) as t(n, f)
      union all
      select {B}, 'records', n, n, n, 0, f, 0
      from (select count(*), count(distinct (ingest_ordinal - 1000000000) // 100) from fx_hris_b) as t(n, f)
      union all
      select 'Benefits_MedShield', 'records', n, n, n, 0, f, 0
      from (select count(*), count(distinct ingest_ordinal // 50000) from fx_benefits) as t(n, f)""",
}
QUERIES |= {
    "golden_round_trip": _STAMPED,
    "integrate_golden": _STAMPED,
    "data_dictionary": " union all ".join(
        f"select '{c}' as column_name, '{_KINDS.get(c, 'string')}' as data_type, "
        f"'{'NO' if c in _NEVER_NULL else 'YES'}' as nullable, "
        f"count(*) filter ({c} is null) as nulls from golden"
        for c in _COLUMNS
    ),
    "ghost_extract": QUERIES["ghost_report"],
    "match_extract": f"""
      select *, row_number() over (order by similarity_score desc, record_1_id, record_2_id) as place
      from ({QUERIES["probable_match_review"]})""",
    "validation_csv": "select * exclude (check_no) from checks",
    "figures_written": " union all ".join(
        f"select '{figure}' as figure, count(*) as rows from ({QUERIES[name]})"
        for figure, name in _FIGURES.items()
    ),
}

ORACLE_SQL = {name: statement(sql) for name, sql in QUERIES.items()}
