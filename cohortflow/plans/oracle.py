"""The registered queries as plain SQL over the given tables.

Written from the semantics, not from the Spark plans: intervals are joined by range, pairs by
self-join, sequences by one window per patient.
"""

from __future__ import annotations

import re

from .domains import (
    ANTIMICROBIAL_PATTERN,
    CHRONIC_CAREPLAN_PATTERN,
    HIGH_RISK_MEDICATION_PATTERN,
    MAJOR_PROCEDURE_PATTERN,
    OBSERVATION_CODES,
    PREVENTIVE_IMMUNIZATION_PATTERN,
    SEVERE_ALLERGY_PATTERN,
)

VISIT = """case left(o_orderpriority, 1) when '1' then 'Emergency hospital admission'
  when '2' then 'Inpatient stay' when '3' then 'Urgent care' when '5' then 'Wellness visit'
  else 'Ambulatory' end"""
REASON = """case when o_orderkey % 5 = 0
  then (o_orderkey % 90 + 10)::varchar || ' Follow-up ' || o_orderstatus end"""
SEEN = "timestamp '2024-02-01 00:00:00'"


def measure(i: int, name: str) -> str:
    return f"max(case when l_linenumber = {i} then val end) as {name}"


def blank(column: str) -> str:
    return f"({column} is null or trim({column}) = '')"


def codes(*rules: tuple[str, str]) -> str:
    """All failing codes, joined."""
    cases = ", ".join(f"case when {p} then '{c}' end" for c, p in rules)
    return f"concat_ws(', ', {cases})"


def first(*rules: tuple[str, str], default: str = "null") -> str:
    cases = " ".join(f"when {p} then '{c}'" for c, p in rules)
    return f"case {cases} else {default} end"


def round2(value: str) -> str:
    """Two decimals, half up on the decimal value (a binary double can fall just below a tie)."""
    return f"round(({value})::decimal(38, 10), 2)::double"


def pct(part: str, whole: str) -> str:
    return round2(f"case when {whole} > 0 then {part} / {whole} * 100 else 0.0 end")


def mean(column: str) -> str:
    return f"{round2(f'avg({column})')} as avg_{column}"


def kind(*cases: str) -> str:
    *special, other = cases
    pairs = zip(special[::2], special[1::2])
    whens = " ".join(f"when '{t}' then '{w}'" for t, w in pairs)
    return f"p_name || ' ' || case p_type {whens} else '{other}' end"


MEDICATION = kind("MEDIUM", "insulin", "ECONOMY", "amoxicillin", "acetaminophen")
PROCEDURE = kind("PROMO", "replacement", "SMALL", "biopsy", "examination")
CAREPLAN = kind("LARGE", "Diabetes self management", "STANDARD", "Exercise therapy", "General plan")
ALLERGY = kind("ECONOMY", "Allergy to peanut", "SMALL", "Latex allergy", "Allergy to pollen")
IMMUNIZATION = kind("MEDIUM", "Influenza seasonal", "LARGE", "Td adult", "Measles")


def hit(expr: str, pattern: str) -> str:
    return f"regexp_matches(lower({expr}), '{pattern}')"


RAW_RULES = (
    ("ERR_MISSING_ENCOUNTER_ID", blank("encounter_id")),
    ("ERR_MISSING_PATIENT_ID", blank("patient_id")),
    ("ERR_MISSING_OR_INVALID_DATE", "admission_date is null"),
    ("ERR_FUTURE_DATE", f"admission_date > {SEEN}"),
    ("ERR_MISSING_CODE", blank("diagnosis_code")),
)
VITAL_RULES = (
    ("MISSING_EVENT_ID", blank("event_id")),
    ("MISSING_PATIENT_ID", blank("patient_id")),
    ("INVALID_EVENT_TIMESTAMP", "event_timestamp is null"),
    ("FUTURE_EVENT_TIMESTAMP", f"event_timestamp > {SEEN}"),
    ("INVALID_HEART_RATE", "heart_rate < 20 or heart_rate > 250"),
    ("INVALID_SYSTOLIC_BP", "systolic_bp < 50 or systolic_bp > 260"),
    ("INVALID_DIASTOLIC_BP", "diastolic_bp < 30 or diastolic_bp > 180"),
    ("INVALID_TEMPERATURE", "temperature < 30 or temperature > 45"),
)
EVENT_RULES = (
    ("MISSING_EVENT_ID", blank("event_id")),
    ("MISSING_ENCOUNTER_ID", blank("encounter_id")),
    ("MISSING_PATIENT_ID", blank("patient_id")),
    ("MISSING_ENCOUNTER_TYPE", blank("encounter_type")),
    ("INVALID_EVENT_TIMESTAMP", "event_timestamp is null"),
    ("FUTURE_EVENT_TIMESTAMP", f"event_timestamp > {SEEN}"),
    ("NEGATIVE_LENGTH_OF_STAY", "length_of_stay_hours < 0"),
)
ERROR_RULES = (
    ("ERR_MISSING_ENCOUNTER_ID", blank("encounter_id")),
    ("ERR_MISSING_PATIENT_ID", blank("patient_id")),
    ("ERR_MISSING_ADMISSION_DATE", "admission_date is null"),
    ("ERR_MISSING_ICD10", blank("diagnosis_code")),
    ("ERR_CHRONO_FLOW", "discharge_date <= admission_date"),
)
WARNING_RULES = (
    ("WARN_MISSING_BMI", "bmi is null"),
    ("WARN_MISSING_BP", "systolic_bp is null or diastolic_bp is null"),
    (
        "WARN_MISSING_DEMOGRAPHICS",
        "gender is null or gender = 'UNKNOWN' or race is null or race = 'UNKNOWN'",
    ),
    ("WARN_MISSING_MEDICATION_CONTEXT", "unique_medications is null or unique_medications <= 0"),
    ("WARN_MISSING_CONDITION_CONTEXT", "condition_count is null or condition_count <= 0"),
    ("WARN_MISSING_OBSERVATION_CONTEXT", "observation_count is null or observation_count <= 0"),
)
REASON_RULES = (
    ("recent_readmission", "is_readmitted_30d = 1"),
    ("age_65_plus", "age >= 65"),
    ("high_risk_medication", "high_risk_med_count > 0"),
    ("polypharmacy", "unique_medications >= 5"),
    ("chronic_condition_burden", "chronic_condition_count >= 2"),
    ("abnormal_vitals", "abnormal_vital_count >= 2"),
    ("major_procedure", "major_procedure_count > 0"),
    ("severe_allergy", "severe_allergy_count > 0"),
    ("high_utilization", "clinical_burden_score >= 12"),
)
POINTS = (
    ("is_readmitted_30d = 1", 35),
    ("high_risk_med_count > 0", 20),
    ("unique_medications >= 4", 15),
    ("abnormal_vital_count >= 2", 15),
    ("condition_count >= 3", 10),
    ("chronic_condition_count >= 2", 10),
    ("major_procedure_count > 0", 10),
    ("chronic_careplan_count > 0", 5),
    ("severe_allergy_count > 0", 5),
    ("age >= 65", 10),
    ("los_days >= 7", 5),
)
COUNTS = (
    "condition_count chronic_condition_count observation_count abnormal_vital_count "
    "medication_events unique_medications high_risk_med_count antimicrobial_count "
    "max_medication_days procedure_count unique_procedures major_procedure_count "
    "careplan_count unique_careplans chronic_careplan_count allergy_count "
    "severe_allergy_count immunization_count preventive_immunization_count"
).split()
FLAGS = [f"reason_{name}" for name, _ in REASON_RULES]
MAXIMA = [
    "clinical_burden_score",
    *FLAGS,
    *(
        "condition_count chronic_condition_count unique_medications high_risk_med_count "
        "abnormal_vital_count procedure_count major_procedure_count careplan_count "
        "preventive_immunization_count severe_allergy_count gender race age_group"
    ).split(),
]
FILLED = ", ".join(f"coalesce({c}, 0) as {c}" for c in COUNTS)


def event_counts(columns: str, key: str, name: str, pattern: str, text: str, rows: bool) -> str:
    total, distinct, matched = columns.split()
    first_column = f"count(*) as {total}, " if rows else ""
    return f"""select {key} as {name}, {first_column}count(distinct code) as {distinct},
      count(*) filter ({hit(text, pattern)}) as {matched} from ln group by {key}"""


CTES = {
    "enc": f"""select o_orderkey::varchar as encounter_id, o_custkey::varchar as patient_id,
      o_orderdate as admission_date, o_orderstatus as diagnosis_code, {VISIT} as description,
      {REASON} as reason_description from orders""",
    "raw": f"""select o_orderkey as row_number,
      case when o_orderkey % 101 = 0 then '' when o_orderkey % 103 = 0 then null
        else o_orderkey::varchar end as id,
      case when o_orderkey % 61 = 0 then 'not-a-date' when o_orderkey % 67 = 0 then ''
        when o_orderkey % 71 = 0 then '2999-01-01 00:00:00' else o_orderdate::varchar end as dt,
      case when o_orderkey % 53 = 0 then ' ' when o_orderkey % 59 = 0 then 'nobody'
        else o_custkey::varchar end as patient,
      case when o_orderkey % 73 = 0 then null else o_orderstatus end as code,
      {VISIT} as description, '' as reasoncode, {REASON} as reason from orders""",
    "rawc": """select row_number, id as encounter_id, patient as patient_id,
      try_cast(dt as timestamp) as admission_date, code as diagnosis_code, description,
      reason as reason_description from raw""",
    "rawt": f"select *, {codes(*RAW_RULES)} as failure_reasons from rawc",
    "rawp": """select c_custkey::varchar as id,
      case when c_custkey % 17 = 0 then 'unknown'
        else (date '1930-01-01' + (c_custkey * 37 % 25000)::int)::varchar end as birthdate,
      case when c_acctbal < 0 then '1999-01-01' end as deathdate, c_mktsegment as race,
      case when c_nationkey % 2 = 0 then 'F' else 'M' end as gender, c_name as ssn
      from customer""",
    "pat": """select id as patient_id, gender, race,
      coalesce(try_cast(birthdate as date), date '1980-01-01') as birthdate,
      try_cast(deathdate as date) as deathdate, ssn from rawp""",
    "ln": """select o_custkey::varchar as patient, l_orderkey::varchar as encounter,
      l_partkey::varchar as code, p_brand, p_name, p_type,
      case when (l_orderkey + l_linenumber) % 83 = 0 then null else l_shipdate::date end as st,
      case when l_returnflag <> 'N' then l_shipdate::date + l_quantity::int end as sp
      from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "ob": """select l_orderkey::varchar as encounter, l_linenumber,
      case when l_partkey % 11 <> 0 then (l_quantity * 4)::int::double end as val from lineitem""",
    "f_obs": f"""select *, (case when bmi >= 30 then 1 else 0 end)
        + (case when systolic_bp >= 140 then 1 else 0 end)
        + (case when diastolic_bp >= 90 then 1 else 0 end) as abnormal_vital_count
      from (select encounter as encounter_id, count(*) as observation_count,
        {", ".join(measure(i, n) for i, n in enumerate(OBSERVATION_CODES, 1))}
        from ob group by 1)""",
    "f_cond": """select encounter as encounter_id,
      string_agg(distinct p_brand, ' | ' order by p_brand) as condition_names,
      max(p_brand) as primary_condition_name, count(*) as condition_count,
      count(*) filter (sp is null) as chronic_condition_count,
      max(date_diff('day', st, sp)) as max_condition_duration_days from ln group by 1""",
    "active": f"""select e.encounter_id, m.code, {MEDICATION} as name, m.st, m.sp
      from enc e left join ln m on e.patient_id = m.patient and m.st <= e.admission_date::date
        and (m.sp is null or m.sp >= e.admission_date::date)""",
    "f_med": f"""select encounter_id, count(code) as medication_events,
      count(distinct code) as unique_medications,
      count(distinct case when {hit("name", HIGH_RISK_MEDICATION_PATTERN)} then code end)
        as high_risk_med_count,
      count(distinct case when {hit("name", ANTIMICROBIAL_PATTERN)} then code end)
        as antimicrobial_count,
      max(date_diff('day', st, sp)) as max_medication_days from active group by 1""",
    "f_proc": event_counts(
        "procedure_count unique_procedures major_procedure_count",
        "encounter", "encounter_id", MAJOR_PROCEDURE_PATTERN, PROCEDURE, True,
    ),
    "f_care": event_counts(
        "careplan_count unique_careplans chronic_careplan_count",
        "encounter", "encounter_id", CHRONIC_CAREPLAN_PATTERN, CAREPLAN, True,
    ),
    "f_all": event_counts(
        "n allergy_count severe_allergy_count",
        "patient", "patient_id", SEVERE_ALLERGY_PATTERN, ALLERGY, False,
    ),
    "f_imm": event_counts(
        "n immunization_count preventive_immunization_count",
        "patient", "patient_id", PREVENTIVE_IMMUNIZATION_PATTERN, IMMUNIZATION, False,
    ),
    "rich": """select * from enc left join f_cond using (encounter_id)
      left join f_obs using (encounter_id) left join f_med using (encounter_id)
      left join f_proc using (encounter_id) left join f_care using (encounter_id)
      left join pat using (patient_id) left join f_all using (patient_id)
      left join f_imm using (patient_id)""",
    "stay": """select *, case when regexp_matches(lower(description),
        'inpatient|hospital admission|emergency hospital') then 3 else 1 end as los_days
      from enc""",
    "stayd": "select *, admission_date::date + los_days as discharge_date from stay",
    "silver": f"""select *, case when age < 18 then '0-17' when age < 40 then '18-39'
        when age < 60 then '40-59' else '60+' end as age_group,
      admission_date::date + los_days as discharge_date
      from (select r.* exclude ({", ".join(COUNTS)}, gender, race, condition_names), {FILLED},
        coalesce(gender, 'UNKNOWN') as gender, coalesce(race, 'UNKNOWN') as race,
        coalesce(condition_names, 'General Outpatient Checkup') as condition_names,
        trim(regexp_replace(coalesce(reason_description, primary_condition_name,
          'General Clinical Encounter'), '^[0-9]+\\s*', '')) as condition_name,
        case when regexp_matches(lower(description),
          'inpatient|hospital admission|emergency hospital') then 3 else 1 end as los_days,
        datesub('year', birthdate, date '2002-01-01') as age from rich r)""",
    "seq": """select *, date_diff('day', prev_admission::date, admission_date::date)
        as return_gap_days,
      date_diff('day', prev_discharge, admission_date::date) as days_since_discharge,
      case when date_diff('day', prev_discharge, admission_date::date) between 1 and 30
        and prev_los > 0 then 1 else 0 end as is_readmitted_30d
      from (select *, lag(admission_date) over w as prev_admission,
        lag(discharge_date) over w as prev_discharge, lag(los_days) over w as prev_los
        from stayd window w as (partition by patient_id order by admission_date, encounter_id))""",
    "scored0": """select s.* replace (least(high_risk_med_count, unique_medications)
        as high_risk_med_count), q.is_readmitted_30d, q.return_gap_days,
      least(condition_count, 5) + least(unique_medications, 5) + least(procedure_count, 5)
        + least(abnormal_vital_count, 3) + least(careplan_count, 2) as clinical_burden_score,
      case when chronic_condition_count > 0 and chronic_careplan_count <= 0
          and abnormal_vital_count >= 2 then 'CRITICAL'
        when chronic_condition_count > 0 and chronic_careplan_count <= 0 then 'WARNING'
        when observation_count <= 0 or preventive_immunization_count <= 0 then 'INFO'
        else 'NONE' end as care_gap_severity
      from silver s join seq q using (encounter_id)""",
    "scored1": f"""select *, least(100, {" + ".join(
        f"(case when {p} then {n} else 0 end)" for p, n in POINTS)}) as readmission_risk_score,
      {", ".join(f"case when {p} then 1 else 0 end as reason_{n}" for n, p in REASON_RULES)},
      case care_gap_severity when 'CRITICAL' then 'Schedule urgent chronic care follow-up'
        when 'WARNING' then 'Review care plan coverage'
        when 'INFO' then 'Refresh preventive care or vitals data' else 'Monitor' end
        as recommended_action
      from scored0""",
    "scored": f"""select *, case when readmission_risk_score >= 60 then 'HIGH'
        when readmission_risk_score >= 30 then 'MEDIUM' else 'LOW' end as readmission_risk_band,
      {codes(*[(n, f"reason_{n} = 1") for n, _ in REASON_RULES])} as risk_reasons
      from scored1""",
    "met": """select condition_name, avg(los_days) as avg_los_days,
      avg(is_readmitted_30d) as readmission_rate,
      avg(readmission_risk_score) as avg_readmission_risk_score,
      avg(unique_medications) as avg_unique_medications,
      avg(abnormal_vital_count) as avg_abnormal_vitals, avg(condition_count) as avg_condition_count,
      avg(procedure_count) as avg_procedure_count, avg(careplan_count) as avg_careplan_count,
      avg(allergy_count) as avg_allergy_count, avg(immunization_count) as avg_immunization_count,
      count(distinct encounter_id) as total_encounters,
      count(*) filter (readmission_risk_band = 'HIGH') as high_risk_patients
      from scored group by 1""",
    "demo": """select race, gender, age_group, count(*) as unique_patients from (
      select * from scored qualify row_number() over
        (partition by patient_id order by admission_date desc, encounter_id desc) = 1)
      group by all""",
    "plab": """select distinct patient_id, trim(l) as l from (select patient_id, unnest(string_split(
        case when condition_names <> 'General Outpatient Checkup' then condition_names
          when condition_name <> 'General Clinical Encounter' then condition_name else '' end,
        '|')) as l from scored) where trim(l) <> ''""",
    "plist": "select patient_id, string_agg(l, ' | ' order by l) as names from plab group by 1",
    "p360": f"""select g.*, coalesce(names, 'No condition linked') as condition_names,
      case when risk_score >= 60 then 'HIGH' when risk_score >= 30 then 'MEDIUM' else 'LOW' end
        as risk_band,
      {codes(*[(n, f"reason_{n} = 1") for n, _ in REASON_RULES])} as risk_reasons,
      case when reason_recent_readmission = 1 then 'Review recent return and follow-up'
        when reason_abnormal_vitals = 1 then 'Review abnormal vitals'
        when reason_high_risk_medication = 1 then 'Medication safety review'
        when reason_chronic_condition_burden = 1 then 'Chronic care plan review'
        else 'Routine monitoring' end as suggested_focus
      from (select patient_id, max(readmission_risk_score) as risk_score,
        {", ".join(f"max({c}) as {c}" for c in MAXIMA)} from scored group by 1) g
      left join plist using (patient_id)""",
    "gap": """select patient_id, encounter_id, condition_name, care_gap_severity,
      recommended_action, chronic_condition_count, chronic_careplan_count, observation_count,
      abnormal_vital_count, preventive_immunization_count, readmission_risk_score
      from scored where care_gap_severity <> 'NONE'
      qualify row_number() over (partition by patient_id order by
        case care_gap_severity when 'CRITICAL' then 1 when 'WARNING' then 2 else 3 end,
        readmission_risk_score desc, admission_date desc, encounter_id desc) = 1""",
    "lab": """select distinct patient_id, trim(l) as condition from (
      select patient_id, unnest(string_split(condition_names, '|')) as l from scored)
      where trim(l) <> '' and not regexp_matches(lower(l),
        'general clinical encounter|general outpatient checkup')""",
    "pair": """select a.condition as condition_a, b.condition as condition_b,
      count(*) as patient_count from lab a join lab b
      on a.patient_id = b.patient_id and a.condition < b.condition
      group by 1, 2 order by 3 desc, 1, 2 limit 50""",
    "hist": """select patient as patient_id, p_brand as condition_name, min(st) as condition_start
      from ln group by 1, 2""",
    "dead": """select condition_name, count(*) as deceased_patients from hist join pat
      using (patient_id) where deathdate is not null
      and (condition_start is null or condition_start <= deathdate) group by 1""",
    "rankd": f"""select condition_name, affected_patients, coalesce(deceased_patients, 0)
        as deceased_patients,
      {pct("coalesce(deceased_patients, 0)", "affected_patients")} as deceased_association_pct
      from (select condition_name, count(*) as affected_patients from hist
        where patient_id in (select patient_id from enc) group by 1)
      left join dead using (condition_name)""",
    "vit": """select event_id as n,
      case when event_id % 97 = 0 then null else event_id::varchar end as event_id,
      case when event_id % 47 = 0 then ' ' else user_id::varchar end as patient_id,
      'enc-' || event_id::varchar as encounter_id, event_type,
      case when event_id % 41 = 0 then 'no time' when event_id % 43 = 0
        then '2099-01-01 00:00:00' else ts::varchar end as at_text,
      case when event_id % 13 = 0 then null else floor(value) + 10 + c.copy end as heart_rate,
      80 + floor(value * 3)::bigint % 200::double as systolic_bp,
      case when event_id % 19 = 0 then null else 20 + floor(value * 7)::bigint % 170::double end
        as diastolic_bp,
      29 + (floor(value * 10)::bigint % 68) / 4 as temperature, 'bedside' as source,
      'vitals' as kafka_topic, (event_id % 4)::int as kafka_partition,
      event_id * 2 + c.copy as kafka_offset,
      ts + to_minutes(c.copy) as kafka_timestamp, user_id::varchar as kafka_key
      from events, (values (0), (1)) c(copy) where c.copy = 0 or event_id % 5 = 0""",
    "vitb": "select *, try_cast(at_text as timestamp) as event_timestamp from vit",
    "vitd": f"""select * from vitb qualify event_id is null or row_number() over (
      partition by event_id order by kafka_timestamp desc, kafka_offset desc) = 1""",
    "vitf": f"""select *, coalesce(heart_rate < 60 or heart_rate > 100, false)
        as abnormal_heart_rate,
      coalesce(systolic_bp < 90 or systolic_bp > 140 or diastolic_bp < 60 or diastolic_bp > 90,
        false) and systolic_bp is not null and diastolic_bp is not null
        as abnormal_blood_pressure,
      coalesce(temperature < 36.0 or temperature > 37.5, false) as abnormal_temperature
      from vitd""",
    "vitc": f"""select *, abnormal_heart_rate or abnormal_blood_pressure or abnormal_temperature
        as has_abnormal_vitals, {first(*VITAL_RULES)} as validation_error from vitf""",
    "vits": "select * from vitc where validation_error is null",
    "vitq": "select * from vitc where validation_error is not null",
    "vsum": f"""select *, {pct("abnormal_vitals_count", "total_vitals_events")}
        as abnormal_rate_pct from (select count(*) as total_vitals_events,
      count(*) filter (has_abnormal_vitals) as abnormal_vitals_count,
      {mean('heart_rate')}, {mean('systolic_bp')},
      {mean('diastolic_bp')},
      {mean('temperature')},
      count(distinct patient_id) as patients_monitored,
      max(event_timestamp) as latest_event_time from vits)""",
    "vpat": f"""select *, abnormal_vitals_events > 0 as has_abnormal_vitals,
      {pct("abnormal_vitals_events", "vitals_events")} as abnormal_rate_pct
      from (select patient_id, count(*) as vitals_events,
      count(*) filter (has_abnormal_vitals) as abnormal_vitals_events,
      {mean('heart_rate')}, {mean('systolic_bp')},
      {mean('diastolic_bp')},
      {mean('temperature')},
      max(event_timestamp) as latest_event_time from vits group by 1)""",
    "ev": f"""select case when event_id % 97 = 0 then '' else event_id::varchar end as event_id,
      case when event_id % 89 = 0 then null else 'enc-' || event_id::varchar end as encounter_id,
      case when event_id % 47 = 0 then ' ' else user_id::varchar end as patient_id,
      case when event_id % 41 = 0 then null when event_id % 43 = 0 then timestamp '2099-01-01'
        else ts end as event_timestamp,
      case when event_id % 83 = 0 then '' else case event_type when 'error' then 'Emergency'
        when 'purchase' then 'inpatient' when 'signup' then 'wellness'
        when 'click' then 'ambulatory' else 'urgentcare' end end as encounter_type,
      case when event_id % 7 = 0 then '' else event_type end as diagnosis_code,
      case when event_id % 37 = 0 then -5.0 when event_id % 29 = 0 then null
        else floor(value) end as length_of_stay_hours from events""",
    "evf": f"""select *, coalesce(length_of_stay_hours >= 24, false) as is_long_stay,
      lower(encounter_type) = 'emergency' as is_emergency, trim(diagnosis_code) <> ''
        as has_diagnosis, {first(*EVENT_RULES)} as validation_error from ev""",
    "evc": "select *, is_emergency or is_long_stay as encounter_risk_flag from evf",
    "evs": "select * from evc where validation_error is null",
    "log": """select event_id as kafka_offset, event_id % 31 <> 0 and event_id % 29 <> 0 as ok,
      case event_type when 'click' then 'encounters' when 'view' then 'observations'
        when 'purchase' then 'medications' when 'signup' then 'patients' else 'billing' end
        as dom,
      case when event_id % 23 = 0 then ' ' else user_id::varchar end as patient,
      case when event_id % 19 = 0 then '' else ts::date::varchar end as dt,
      event_id, ts from events""",
    "logv": """select *, case when not ok or dom = 'billing' then 'invalid_kafka_envelope'
      when dom = 'encounters' and (trim(patient) = '' or dt = '')
        or dom = 'observations' and (trim(patient) = '' or dt = '')
        or dom = 'medications' and trim(patient) = ''
        then 'missing_required_payload_fields' else '' end as validation_error from log""",
    "aud0": """select day(ts)::bigint as batch_id, date_trunc('day', min(ts))::timestamp
        as execution_timestamp, count(*) as source_records_read,
      count(*) filter (not bad and not rep) as silver_records_written,
      count(*) filter (bad) as quarantine_records_written,
      count(*) filter (not bad and not rep and value > 100) as warning_records,
      count(*) filter (rep) as duplicate_records_skipped, 12.5::double as duration_seconds
      from (select *, value < 10 or value > 240 as bad,
        not (value < 10 or value > 240) and event_id % 50 = 1 as rep from events)
      group by ts::date, day(ts)""",
    "aud": f"""select *, quarantine_records_written as hard_failure_records,
      {pct("(source_records_read - quarantine_records_written)", "source_records_read")}
        as pass_rate_pct,
      {pct("(source_records_read - quarantine_records_written)", "source_records_read")}
        as validation_pass_rate_pct,
      {pct("warning_records", "silver_records_written")} as warning_rate_pct,
      case when quarantine_records_written = 0 then 'SUCCESS' else 'ANOMALIES_ISOLATED' end
        as status, {round2('source_records_read / duration_seconds')}
        as throughput_rows_per_second,
      case when source_records_read = silver_records_written + quarantine_records_written
        + duplicate_records_skipped then 'PASS' else 'FAIL' end as reconciliation_status
      from aud0""",
    "cards0": f"""select 'patients' as table_name, count(*) as t,
        count(*) filter (not {blank("id")} and not {blank("birthdate")}) as c,
        count(*) filter (try_cast(birthdate as date) is not null) as d,
        count(*) filter (not {blank("id")} and not {blank("birthdate")}
          and try_cast(birthdate as date) is not null) as b from rawp
      union all select 'encounters', count(*),
        count(*) filter (not {blank("id")} and not {blank("patient")} and not {blank("dt")}),
        count(*) filter (try_cast(dt as timestamp) is not null),
        count(*) filter (not {blank("id")} and not {blank("patient")} and not {blank("dt")}
          and try_cast(dt as timestamp) is not null) from raw
      union all select unnest(['conditions', 'medications', 'observations', 'procedures',
        'careplans', 'allergies', 'immunizations']), count(*), count(*), count(st), count(st)
        from ln""",
    "cards": f"""select table_name, t as total_records, c as complete_key_records,
      d as valid_date_records, {pct("c", "t")} as completeness_pct,
      {pct("d", "t")} as date_validity_pct, {pct("least(c, d)", "t")} as trust_score_pct,
      {pct("b", "t")} as row_trust_pct from cards0""",
    "gate": """select encounter_id::bigint as row_id,
      s.* exclude (encounter_id, patient_id, admission_date, diagnosis_code, discharge_date,
        gender),
      case when encounter_id::bigint % 101 = 0 then ' ' else encounter_id end as encounter_id,
      case when encounter_id::bigint % 53 = 0 then null else patient_id end as patient_id,
      case when encounter_id::bigint % 61 = 0 then null else admission_date end
        as admission_date,
      case when encounter_id::bigint % 73 = 0 then '' else diagnosis_code end as diagnosis_code,
      case when encounter_id::bigint % 79 = 0 then admission_date::date - 1
        else discharge_date end as discharge_date,
      case when encounter_id::bigint % 67 = 0 then 'UNKNOWN' else gender end as gender
      from silver s""",
    "st": """select patient_id, encounter_id as last_encounter_id,
      admission_date::date::varchar as last_admission_date,
      discharge_date::varchar as last_discharge_date, los_days as last_los_days""",
    "filed": "select *, 'events-' || ts::date::varchar || '.csv' as source_file from events",
}


def _with(body: str) -> str:
    """Prefix the body with the common table expressions it needs, in order."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(re.findall(r"\b[a-z_0-9]+\b", texts.pop()))
        for name in words & CTES.keys() - needed:
            if name == "st":
                continue
            needed.add(name)
            texts.append(CTES[name])
    parts = [f"{n} as ({CTES[n]})" for n in CTES if n in needed]
    return f"with {', '.join(parts)} {body}" if parts else body


LATEST = (
    "qualify row_number() over (partition by patient_id "
    "order by admission_date desc, encounter_id desc) = 1"
)


def state(where: str) -> str:
    return f"{CTES['st']} from stayd where {where} {LATEST}"


def measures(total: str, extra: str, by: str = "") -> str:
    """Encounter feed aggregates with the rate."""
    group = f"group by {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""select *, {pct("risk_flagged_encounters", total)} as risk_flag_rate_pct from (
      select {lead}count(*) as {total}, count(*) filter (is_emergency) as emergency_encounters,
        count(*) filter (is_long_stay) as long_stay_encounters,
        count(*) filter (encounter_risk_flag) as risk_flagged_encounters,
        {mean('length_of_stay_hours')}, {extra}
      from evs {group})"""


BY_TYPE = measures("encounters", "count(distinct patient_id) as unique_patients", "encounter_type")
BY_PATIENT = f"""select *, emergency_encounters > 0 as has_emergency_encounter,
  long_stay_encounters > 0 as has_long_stay,
  risk_flagged_encounters > 0 as has_encounter_risk_flag
  from ({measures("encounters", "max(event_timestamp) as latest_event_time", "patient_id")})"""

SHORT = """list_filter(list_transform(string_split(condition_names, '|'), lambda x: trim(x)),
  lambda x: x <> '')"""
SHORT_LABELS = f"""case when len({SHORT}) > 3 then array_to_string({SHORT}[1:3], ' | ') || ' and '
  || (len({SHORT}) - 3)::varchar || ' more' else array_to_string({SHORT}, ' | ') end"""

RAW_JSON = """json_object('event_id', event_id, 'patient_id', patient_id,
  'encounter_id', encounter_id, 'event_type', event_type, 'event_timestamp', at_text,
  'heart_rate', heart_rate::double, 'systolic_bp', systolic_bp::double,
  'diastolic_bp', diastolic_bp::double, 'temperature', temperature::double,
  'source', source)::varchar"""

BUCKET = """case when return_gap_days <= 7 then '0-7 days'
  when return_gap_days <= 30 then '8-30 days' when return_gap_days <= 90 then '31-90 days'
  else '90+ days' end"""

TARGET = """select encounter_id, patient_id, admission_date, diagnosis_code, 'target' as origin,
  null::int as batch from enc where admission_date < timestamp '1999-01-01'"""
SOURCE = """select encounter_id, patient_id, admission_date, diagnosis_code, 'source' as origin,
  2 as batch from enc where admission_date >= timestamp '1998-01-01'"""

GROUPED = """select case when c_custkey % 10 <> 0 then c_mktsegment end as segment,
  case when c_custkey % 7 <> 0 then c_nationkey end as nation, count(*) as customers"""

CHECKS = (
    ("bronze_not_empty", "(select count(*) from vitb)", "bronze_count", "> 0"),
    (
        "silver_plus_quarantine_not_greater_than_bronze",
        "(select count(*) from vitb) - (select count(*) from vitc)",
        "surplus_bronze_rows",
        ">= 0",
    ),
    (
        "silver_event_id_unique",
        "(select count(*) - count(distinct event_id) from vits)",
        "duplicate_event_ids",
        "= 0",
    ),
    (
        "silver_patient_id_complete",
        f"(select count(*) from vits where {blank('patient_id')})",
        "missing_patient_ids",
        "= 0",
    ),
    (
        "silver_heart_rate_valid",
        "(select count(*) from vits where heart_rate < 20 or heart_rate > 250)",
        "invalid_heart_rates",
        "= 0",
    ),
    ("gold_summary_single_row", "(select count(*) from vsum)", "gold_summary_rows", "= 1"),
    ("gold_patient_not_empty", "(select count(*) from vpat)", "gold_patient_rows", "> 0"),
)

RESULT = {
    "canonical_encounters": """select encounter_id, patient_id, admission_date, diagnosis_code,
      description, reason_description from rawc""",
    "tolerant_cast": """select row_number as "ROW_NUMBER", try_cast(dt as timestamp) as as_timestamp,
      try_cast(dt as timestamp)::date::varchar as as_date, try_cast(id as double) as as_number
      from raw""",
    "payload_projection": """select kafka_offset, case when ok then event_id::varchar end as "ID",
      case when ok then patient end as "PATIENT", case when ok then dt end as "DATE" from log""",
    "envelope_parse": """select kafka_offset, case when ok then dom end as domain,
      case when ok then 'run-1' end as producer_run_id,
      case when ok then event_id end as producer_row_number,
      case when ok then ts::varchar end as producer_timestamp,
      case when ok then 8 end as n_fields from log""",
    "fill_defaults": f"""select encounter_id, coalesce(gender, 'UNKNOWN') as gender,
      coalesce(race, 'UNKNOWN') as race,
      coalesce(condition_names, 'General Outpatient Checkup') as condition_names, {FILLED}
      from rich""",
    "label_normalise": "select encounter_id, condition_name from silver",
    "stay_length": """select encounter_id, los_days, discharge_date::varchar as discharge_date
      from stayd""",
    "age_band": """select patient_id, age, case when age < 18 then '0-17' when age < 40 then '18-39'
      when age < 60 then '40-59' else '60+' end as age_group from (select patient_id,
      datesub('year', birthdate, date '2002-01-01') as age from pat)""",
    "shard_id": """select patient_id, ('0x' || substr(md5(patient_id), 1, 8))::bigint % 5 + 1
      as hospital_id from pat""",
    "mask_identifier": "select patient_id, sha256(ssn) as ssn from pat",
    "encounter_classify": """select encounter_id,
      case when contains(lower(description), 'emergency') then 'emergency'
        when contains(lower(description), 'inpatient') or contains(lower(description), 'hospital')
          then 'inpatient' when contains(lower(description), 'urgent') then 'urgentcare'
        when contains(lower(description), 'wellness') then 'wellness' else 'ambulatory' end
        as encounter_type,
      case when contains(lower(description), 'inpatient')
          or contains(lower(description), 'hospital') then 72.0
        when contains(lower(description), 'emergency') then 8.0 else 1.0 end::double
        as length_of_stay_hours from enc""",
    "build_events": """select 's3-encounter-' || coalesce(id, '') || '-' || row_number as event_id,
      coalesce(id, '') as encounter_id, trim(patient) as patient_id,
      'encounter_replay' as event_type,
      coalesce(strftime(try_cast(dt as timestamp), '%Y-%m-%dT%H:%M:%S+00:00'), '')
        as event_timestamp,
      case left(description, 5) when 'Emerg' then 'emergency' when 'Inpat' then 'inpatient'
        when 'Urgen' then 'urgentcare' when 'Welln' then 'wellness' else 'ambulatory' end
        as encounter_type,
      coalesce(code, '') as diagnosis_code, coalesce(reason, description)
        as diagnosis_description, 'S3 Historical Replay' as facility, 's3-replay' as provider_id,
      case left(description, 5) when 'Emerg' then 72.0 when 'Inpat' then 72.0 else 1.0
        end::double as length_of_stay_hours,
      's3_clinical_encounters' as source, row_number as source_row from raw""",
    "envelope_build": """select coalesce(nullif(id, ''), nullif(patient, '')) as key,
      json_object('domain', 'encounters', 'producer_run_id', 'run-1',
        'producer_row_number', row_number, 'producer_timestamp', '2024-02-01 00:00:00',
        'payload', json_object('ID', coalesce(id, ''), 'DATE', dt, 'PATIENT', patient,
          'CODE', coalesce(code, ''), 'DESCRIPTION', description, 'REASONCODE', '',
          'REASONDESCRIPTION', coalesce(reason, '')))::varchar as value from raw""",
    "explode_labels": "select patient_id, condition from lab",
    "risk_score": "select encounter_id, readmission_risk_score from scored",
    "burden_score": "select encounter_id, clinical_burden_score from scored",
    "risk_band": "select encounter_id, readmission_risk_band as risk_band from scored",
    "reason_codes": f"select encounter_id, {', '.join(FLAGS)}, risk_reasons from scored",
    "care_gap_severity": "select encounter_id, care_gap_severity, recommended_action from scored",
    "suggested_focus": "select patient_id, suggested_focus from p360",
    "vital_flags": """select kafka_offset, abnormal_heart_rate, abnormal_blood_pressure,
      abnormal_temperature, abnormal_heart_rate or abnormal_blood_pressure
        or abnormal_temperature as has_abnormal_vitals from (
      select *, coalesce(heart_rate not between 60 and 100, false) as abnormal_heart_rate,
        case when systolic_bp is null or diastolic_bp is null then false
          else systolic_bp not between 90 and 140 or diastolic_bp not between 60 and 90 end
          as abnormal_blood_pressure,
        coalesce(temperature not between 36.0 and 37.5, false) as abnormal_temperature
        from vitb)""",
    "encounter_flags": """select event_id, is_long_stay, is_emergency, has_diagnosis,
      encounter_risk_flag from evc""",
    "short_labels": f"select patient_id, {SHORT_LABELS} as top_conditions from p360",
    "unpivot_signals": f"""select encounter_type, unnest(['long_stay_encounters',
      'emergency_encounters']) as risk_signal,
      unnest([long_stay_encounters, emergency_encounters]) as encounters from ({BY_TYPE})""",
    "raw_validation": 'select row_number as "ROW_NUMBER", failure_reasons from rawt',
    "reference_check": f"""select row_number as "ROW_NUMBER", patient_id, concat_ws(', ',
      nullif(failure_reasons, ''), case when not {blank("patient_id")} and patient_id not in
      (select patient_id from pat) then 'ERR_UNRESOLVED_PATIENT_REFERENCE' end)
      as failure_reasons from rawt""",
    "quarantine_split": f"""select row_number as "ROW_NUMBER",
      case when failure_reasons = '' then 'CLEAN' else 'RAW_VALIDATION' end as quality_stage,
      failure_reasons as quarantine_reason,
      case when failure_reasons <> '' then {SEEN} end as quarantined_at from rawt""",
    "clinical_gate": f"""select row_id, {codes(*ERROR_RULES)} as failure_reasons,
      {codes(*WARNING_RULES)} as quality_warning_codes from gate""",
    "warning_status": f"""select row_id, case when w > 0 then 'VALID_WITH_WARNINGS' else 'VALID' end
      as quality_status, w as quality_warning_count from (select row_id, {" + ".join(
          f"(case when {p} then 1 else 0 end)" for _, p in WARNING_RULES)} as w from gate)""",
    "vitals_validation": f"select kafka_offset, {first(*VITAL_RULES)} as validation_error from vitb",
    "encounter_event_validation": "select event_id, patient_id, validation_error from evc",
    "envelope_validation": """select kafka_offset, case when ok then dom end as domain,
      validation_error from logv""",
    "source_row_validation": f"""select row_number as "ROW_NUMBER",
      case when row_number % 107 = 0 then 'embedded_csv_header'
        when {blank("id")} or {blank("patient")} or {blank("dt")}
          then 'missing_required_fields:' || concat_ws(',',
            case when {blank("id")} then 'ID' end, case when {blank("patient")} then 'PATIENT' end,
            case when {blank("dt")} then 'DATE' end) else '' end as source_error from raw""",
    "event_validation": f"""select row_number as source_row, {first(
        ("MISSING_ENCOUNTER_ID", blank("id")), ("MISSING_PATIENT_ID", blank("patient")),
        ("INVALID_EVENT_TIMESTAMP", "try_cast(dt as timestamp) is null"),
        ("MISSING_DIAGNOSIS_CODE", blank("code")))} as validation_error from raw""",
    "dlq_records": f"""select patient_id as key, json_object('source_topic', 'clinical-vitals',
      'domain', 'vitals', 'error_reason', validation_error, 'raw_payload', {RAW_JSON},
      'kafka_topic', kafka_topic, 'kafka_partition', kafka_partition,
      'kafka_offset', kafka_offset, 'kafka_timestamp', kafka_timestamp::varchar,
      'dlq_published_at', '2024-02-01 00:00:00')::varchar as value from vitq""",
    "completeness_scorecard": "select * from cards",
    "batch_audit": "select * from aud",
    "check_suite": " union all ".join(
        f"""select '{name}' as check_name, {v} {test} as passed,
        '{label}=' || ({v})::varchar as details"""
        for name, v, label, test in CHECKS
    ),
    "quality_gate": """select batch_id, execution_timestamp, pass_rate_pct,
      95.0::double as threshold_pct, pass_rate_pct >= 95 as gate_passed from aud
      order by execution_timestamp desc, batch_id desc limit 1""",
    "stream_audit": f"""select *, q as hard_failure_records, 0.0::double as duration_seconds,
      0 as warning_records, {pct("(source_records_read - q)", "source_records_read")}
        as pass_rate_pct,
      {pct("(source_records_read - q)", "source_records_read")} as validation_pass_rate_pct,
      0.0::double as warning_rate_pct, case when q = 0 then 'SUCCESS' else 'ANOMALIES_ISOLATED'
        end as status, 0.0::double as throughput_rows_per_second,
      'PASS' as reconciliation_status from (select
      (select max(batch_id) + 1 from aud) as batch_id,
      (select count(*) from vits) as silver_records_written,
      (select count(*) from vitq) as quarantine_records_written,
      (select count(*) from vitb) - (select count(*) from vitc) as duplicate_records_skipped,
      (select count(*) from vitb) as source_records_read,
      (select count(*) from vitq) as q)""".replace("select *,", "select * exclude (q),", 1),
    "enrich_encounters": f"""select * exclude (admission_date, description, ssn)
      replace (birthdate::varchar as birthdate, deathdate::varchar as deathdate) from rich""",
    "interval_join": """select encounter_id, count(code) as active_spans,
      min(st)::varchar as first_start, max(sp)::varchar as last_stop from active group by 1""",
    "skip_processed": """select event_id, source_file from filed where source_file not in
      (select source_file from filed where ts < timestamp '2024-01-16')""",
    "upsert_counts": f"""select count(*) filter (t.encounter_id is not null) as records_updated,
      count(*) filter (t.encounter_id is null) as records_inserted
      from ({SOURCE}) s left join ({TARGET}) t using (encounter_id)""",
    "comorbidity_pairs": "select * from pair",
    "disease_rankings": "select * from rankd",
    "top_diseases": "select * from rankd order by deceased_patients desc, condition_name limit 10",
    "deceased_associations": "select * from dead",
    "return_state": f"""select encounter_id, last_discharge_date as previous_discharge_date,
      gap as days_since_previous_discharge,
      case when gap between 1 and 30 and last_los_days > 0 then 1 else 0 end
        as is_readmitted_online from (select e.encounter_id, last_discharge_date, last_los_days,
        date_diff('day', last_discharge_date::date, e.admission_date::date) as gap
        from stayd e left join ({state("admission_date < timestamp '1999-01-01'")}) t
        using (patient_id) where e.admission_date >= timestamp '1999-01-01')""",
    "observation_features": "select * from f_obs",
    "condition_features": "select * from f_cond",
    "first_onset": """select patient_id, condition_name, condition_start::varchar
      as condition_start from hist""",
    "medication_features": "select * from f_med",
    "procedure_features": "select * from f_proc",
    "careplan_features": "select * from f_care",
    "allergy_features": "select * from f_all",
    "immunization_features": "select * from f_imm",
    "condition_metrics": "select * from met",
    "demographics": "select * from demo",
    "patient_360": "select * from p360",
    "care_gap_worklist": "select * from gap",
    "return_gaps": f"""select {BUCKET} as return_gap_bucket,
      count(distinct encounter_id) as encounter_count, count(distinct patient_id)
      as patient_count from seq where return_gap_days >= 0 group by 1""",
    "return_sequence": """select encounter_id, prev_admission, prev_discharge::varchar
      as prev_discharge, prev_los, return_gap_days, days_since_discharge, is_readmitted_30d
      from seq""",
    "vitals_summary": "select * from vsum",
    "vitals_by_patient": "select * from vpat",
    "encounter_summary": measures(
        "total_encounters",
        "count(distinct patient_id) as unique_patients, max(event_timestamp) as latest_event_time",
    ),
    "encounters_by_type": BY_TYPE,
    "encounters_by_patient": BY_PATIENT,
    "file_ledger": """select source_file as file_name, count(*) as record_count,
      sha256(source_file) as file_name_hash, 'SUCCESS' as status from filed group by 1""",
    "serving_kpis": """select count(distinct patient_id) as patients_monitored,
      count(*) filter (risk_band = 'HIGH') as high_risk_patients,
      count(*) filter (reason_recent_readmission = 1) as recent_return_signal_patients,
      count(*) filter (reason_polypharmacy = 1) as polypharmacy_patients,
      (select count(distinct patient_id) from gap) as care_gap_patients,
      (select count(distinct patient_id) from gap where care_gap_severity = 'CRITICAL')
        as critical_care_gaps,
      (select sum(trust_score_pct::decimal(10, 2))::double / count(*) from cards) as pipeline_trust_score_pct from p360""",
    "duplicate_keys": """select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
      group by 1, 2 having count(*) > 1""",
    "latest_per_key": state("true"),
    "latest_by_natural_key": """select sha256('["' || l_orderkey || '","' || l_linenumber || '"]')
        as record_key,
      sha256(json_object('CODE', l_linenumber::varchar, 'DATE', l_shipdate::date::varchar,
        'ENCOUNTER', l_orderkey::varchar, 'VALUE', l_quantity::int::varchar)::varchar)
        as record_hash,
      l_partkey * 100000000 + round(l_extendedprice * 100)::bigint as kafka_offset,
      l_orderkey::varchar as "ENCOUNTER", l_linenumber::varchar as "CODE",
      l_quantity::int::varchar as "VALUE", l_shipdate::date::varchar as "DATE" from lineitem
      qualify row_number() over (partition by l_orderkey, l_linenumber order by
        l_shipdate desc, l_suppkey % 4 desc,
        l_partkey * 100000000 + round(l_extendedprice * 100)::bigint desc) = 1""",
    "event_dedup": "select event_id, kafka_offset, heart_rate from vitd",
    "balanced_top_n": """select patient_id, risk_band, risk_score,
      case risk_band when 'HIGH' then 1 when 'MEDIUM' then 2 else 3 end as band_order from p360
      qualify row_number() over (partition by risk_band order by risk_score desc, patient_id)
        <= 250""",
    "dedup_by_key": """select * from lineitem qualify row_number() over (
      partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "upsert_merge": f"""select * from ({TARGET}) where encounter_id not in
      (select encounter_id from ({SOURCE})) union all select * from ({SOURCE})""",
    "upsert_nullsafe": f"""select * from ({GROUPED}, 'target' as origin from customer
        where c_acctbal < 9000 group by 1, 2) t where not exists (select 1 from ({GROUPED}
        from customer where c_acctbal > 8000 group by 1, 2) s
        where s.segment is not distinct from t.segment and s.nation is not distinct from t.nation)
      union all select * from ({GROUPED}, 'source' as origin from customer
        where c_acctbal > 8000 group by 1, 2)""",
    "upsert_conditional": f"""select case when use_source then s.patient_id else t.patient_id end
        as patient_id, {", ".join(f"case when use_source then s.{c} else t.{c} end as {c}" for c in (
            "last_encounter_id", "last_admission_date", "last_discharge_date", "last_los_days"))}
      from (select s, t, t.patient_id is null or coalesce(
        s.last_admission_date >= t.last_admission_date, false) as use_source
      from ({state("diagnosis_code = 'O'")}) s full join ({state("diagnosis_code <> 'O'")}) t
      on s.patient_id = t.patient_id)""",
    "event_bronze": """select event_id, patient_id, encounter_id, event_type, event_timestamp,
      heart_rate, systolic_bp, diastolic_bp, temperature, source, kafka_topic, kafka_partition,
      kafka_offset, kafka_timestamp, kafka_key from vitb""",
    "incremental_slice": """select event_id, user_id, event_type from events
      where event_id > 2000 order by event_id limit 5000""",
    "micro_batch_silver": f"""select encounter_id, patient_id, condition_name, los_days,
      discharge_date::varchar as discharge_date, unique_medications, observation_count,
      allergy_count, ('0x' || substr(md5(patient_id), 1, 8))::bigint % 5 + 1 as hospital_id,
      case when w > 0 then 'VALID_WITH_WARNINGS' else 'VALID' end as quality_status,
      w as quality_warning_count from (select *, {" + ".join(
          f"(case when {p} then 1 else 0 end)" for _, p in WARNING_RULES)} as w from silver)
      where encounter_id in (select encounter_id from rawt where failure_reasons = ''
        and patient_id in (select patient_id from pat))""",
    "domain_router": """select case when validation_error = '' then dom else '_invalid' end as route,
      validation_error, count(*) as records from logv group by 1, 2""",
    "kpi_summary": f"""select count(distinct patient_id) as patients_monitored,
      count(*) filter (risk_band = 'HIGH') as high_risk_patients,
      {mean('risk_score')} from p360""",
    "risk_distribution": "select risk_band, count(*) as patient_count from p360 group by 1",
    "top_patients": """select patient_id, risk_score, risk_band, risk_reasons, condition_names,
      suggested_focus from p360 order by risk_score desc, patient_id limit 100""",
    "top_conditions": """select condition_name, total_encounters, readmission_rate,
      avg_readmission_risk_score, high_risk_patients from met
      order by total_encounters desc, condition_name limit 100""",
    "riskiest_conditions": """select condition_name, total_encounters, readmission_rate,
      avg_readmission_risk_score, high_risk_patients from met
      order by avg_readmission_risk_score desc, condition_name limit 8""",
    "care_gap_counts": """select care_gap_severity, count(*) as gap_count from gap group by 1
      order by 2 desc, 1 limit 8""",
    "care_gap_actions": """select recommended_action, count(*) as gap_count from gap group by 1
      order by 2 desc, 1 limit 8""",
    "top_care_gaps": """select * from gap order by readmission_risk_score desc, care_gap_severity,
      patient_id limit 500""",
    "recent_audit": "select * from aud order by execution_timestamp desc, batch_id desc limit 10",
    "top_demographics": """select * from demo order by unique_patients desc, race, gender, age_group
      limit 30""",
    "pair_labels": """select left(condition_a, 38) || ' + ' || left(condition_b, 38) as pair,
      patient_count from pair order by patient_count desc, condition_a, condition_b limit 12""",
    "vitals_worklist": """select * from vpat order by abnormal_vitals_events desc,
      latest_event_time desc, patient_id limit 500""",
    "encounter_worklist": f"""select * from ({BY_PATIENT}) order by risk_flagged_encounters desc,
      latest_event_time desc, patient_id limit 500""",
    "worklist_search": f"""select patient_id, risk_band, risk_score, {SHORT_LABELS}
      as top_conditions, unique_medications, risk_reasons, suggested_focus from p360
      where risk_band in ('HIGH', 'MEDIUM') and (contains(lower(patient_id), 'medication')
        or contains(lower(condition_names), 'medication')
        or contains(lower(risk_reasons), 'medication')
        or contains(lower(suggested_focus), 'medication'))
      order by risk_score desc, patient_id limit 50""",
    "abnormal_split": """select unnest(['Normal', 'Abnormal']) as metric,
      unnest([greatest(total_vitals_events - abnormal_vitals_count, 0), abnormal_vitals_count])
      as events from vsum""",
    "dashboard_totals": """select (select sum(total_encounters)::bigint from met) as total_encounters,
      (select sum(unique_patients)::bigint from demo) as mastered_patients,
      (select count(*) from p360 where risk_band = 'HIGH') as high_risk_patients,
      (select batch_id from aud order by execution_timestamp desc, batch_id desc limit 1)
        as latest_batch_id""",
}

_FROM_LOG = """row_number as kafka_offset,
  case when row_number % 2 = 0 then 'run-1' end as producer_run_id,
  case when row_number % 2 = 0 then row_number end as producer_row_number"""
_CANONICAL = "encounter_id, patient_id, admission_date, diagnosis_code, description, reason_description"


def _cursor(name: str, key: str) -> str:
    return f"select '{name}' as source_name, max({key}) as last_key, count(*) as delivered from {name}"


def _section(name: str, table: str, limit: int | None = None) -> str:
    written = f"least({limit}, count(*))" if limit else "count(*)"
    return f"select '{name}' as section, count(*) as total, {written} as written, {written} as n_rows from {table}"


#: The queries of ``landing``: what was written is what is read, but for empty text, which CSV files
#: give back as NULL.
RESULT |= {
    "csv_scan": """select row_number::varchar as "ROW_NUMBER", nullif(id, '') as "ID",
      nullif(dt, '') as "DATE", patient as "PATIENT", code as "CODE", description as "DESCRIPTION",
      nullif(reasoncode, '') as "REASONCODE", reason as "REASONDESCRIPTION" from raw""",
    "csv_quarantine": """select id as "ID", birthdate as "BIRTHDATE", race as "RACE",
      null::varchar as "GENDER", id::bigint % 13 = 0 as quarantined from rawp""",
    "optional_table": "select c_custkey, c_name, true as other_is_absent from customer",
    "append_evolve": """select o_orderkey, o_totalprice,
      case when o_orderkey % 2 = 1 then o_orderstatus end as o_orderstatus from orders""",
    "replace_table": "select p_partkey, p_brand from part",
    "partitioned_write": """select o_orderkey, o_custkey, o_orderstatus,
      case when o_orderstatus = 'F' then 2 else 1 end as written from orders
      where o_orderstatus <> 'F' or o_orderkey % 3 = 0""",
    "upsert_retry": """select c_custkey, c_acctbal,
      case when c_custkey % 2 = 1 or c_custkey % 10 = 0 then 1 end as batch from customer""",
    "upsert_buckets": """select o_orderkey, o_custkey,
      case when o_orderdate >= '1998-01-01' and o_custkey % 100 = 0 then 'second' else 'first' end as origin,
      case when o_orderdate >= '1998-01-01' and o_custkey % 100 = 0 then 2 end as batch from orders
      where o_orderdate < '1999-01-01' or o_custkey % 100 = 0""",
    "views": """select n_name, count(*) as customers, 2 as views from customer
      join nation on c_nationkey = n_nationkey group by 1""",
    "snapshot_sections": " union all ".join(
        (
            _section("clinicalMetrics", "met"),
            _section("demographics", "demo"),
            _section("careGaps", "gap", 250),
            _section("comorbidityPairs", "pair", 50),
            _section("audit", "aud", 50),
        )
    ),
    "files_to_features": """select 'patients' as domain, count(*) as read,
        count(*) filter (c_custkey % 13 = 0) as malformed, count(*) filter (c_custkey % 13 <> 0) as features from customer
      union all select 'encounters', count(*), count(*) filter (o_orderkey % 13 = 0), null from orders
      union all select 'observations', count(*), count(*) filter (l_orderkey % 13 = 0),
        count(distinct l_orderkey) filter (l_orderkey % 13 <> 0) from lineitem""",
    "encounter_log": f"select {_FROM_LOG}, {_CANONICAL} from rawc",
    "log_stream": f"select {_FROM_LOG}, {_CANONICAL} from rawc",
    "dlq_sink": RESULT["dlq_records"],
    "lineage": f"""select row_number as kafka_offset, encounter_id, {SEEN} as ingestion_timestamp,
      patient_id as raw_patient_id, 'file' as raw_source_system from rawc""",
    "drop_private": "select patient_id, gender, race, deathdate::varchar as deathdate, ssn from pat",
    "file_stream": f"""select * replace (nullif(encounter_id, '') as encounter_id)
      from (select {_CANONICAL}, 'file' as source_system from rawc)""",
    "stream_restart": "select event_id, user_id, event_type from events",
    "file_idempotence": """select 'orders-' || left(dt, 4) || '.csv' as source_file,
      case when left(dt, 4) < '1996' then 0 else 1 end as batch_id, count(*) as n_rows
      from raw group by 1, 2""",
    "keyed_state": RESULT["upsert_conditional"],
    "offset_idempotence": """select (row_number % 4)::int as kafka_partition, count(*) as n_rows,
      count(*) as offsets, min(row_number) as first_offset, max(row_number) as last_offset from raw group by 1""",
    "cursor_upsert": " union all ".join(
        _cursor(n, k) for n, k in (("events", "event_id"), ("orders", "o_orderkey"), ("customer", "c_custkey"))
    ),
    "interval_pairs": """select encounter_id, code, st::varchar as start, sp::varchar as stop
      from active""",
    "enrich_hot": """select o_orderkey, nullif(o_custkey, 1) as c_custkey, c_mktsegment from orders
      left join customer on nullif(o_custkey, 1) = c_custkey and c_custkey % 4 <> 0""",
    "sequence_hot": RESULT["return_sequence"],
    "sequence_one_day": """select o_orderkey, lag(o_orderkey) over w as prev_o_orderkey,
      lag(o_totalprice) over w as prev_o_totalprice from orders
      window w as (partition by nullif(left(o_orderpriority, 1), '5')
        order by date_trunc('year', o_orderdate), o_orderkey)""",
    "pairs_wide": """with bought as (select distinct o_custkey as k, p_brand as b from lineitem
      join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey)
      select x.b as condition_a, y.b as condition_b, count(*) as patient_count
      from bought x join bought y on x.k = y.k and x.b < y.b group by 1, 2""",
}

ORACLES = {name: _with(body) for name, body in RESULT.items()}
