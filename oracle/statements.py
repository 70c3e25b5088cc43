"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.ctes import NUMERIC, avg, compose, day, h, total

SQL: dict[str, str] = {}


def i(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {alias or expr}"


def r(expr: str, alias: str | None = None) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias or expr}"


def m(expr: str, alias: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {alias or expr}"


def n(alias: str) -> str:
    return f"count(*) AS {alias}"


# --- sources ---
RAW_NUMBERS = ", ".join(
    [i("los_days"), i("num_procedures"), i("charlson_index"), r("hba1c"), r("creatinine"), r("haemoglobin"),
     r("systolic_bp"), i("readmitted_30d"), i("readmitted_7d")]
)
SQL["raw_admissions"] = f"""SELECT admission_id, patient_id, hospital_id, {day('admit_date')}, {day('discharge_date')},
  admit_type, ward_type, discharge_type, {RAW_NUMBERS} FROM adm_raw"""
SQL["raw_billing"] = f"""SELECT * REPLACE (CAST(claim_billing_date AS VARCHAR) AS claim_billing_date,
  {m('billed_amount')}, {m('paid_amount')}) FROM bill_raw"""
SQL["dirty_admissions"] = "SELECT * FROM adm_text"
SQL["dirty_billing"] = "SELECT * FROM bill_text"

TABLES = ("departments", "patients", "doctors", "admissions", "diagnoses", "procedures", "medicines", "labs",
          "insurance", "billing", "claims", "appointments")
SQL["table_counts"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES)
SQL["load_in_fk_order"] = " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) AS load_order, '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows,"
    f" 'matched' AS status FROM {t}" for k, t in enumerate(TABLES, 1)
)
MART_SIZES = {"model_features": "model_features", "command_center_kpis": "snapshot", "hospital_efficiency_scores": "scores",
              "emergency_forecast": "outlook", "operational_forecast_summary": "plan", "operational_recommendations": "actions"}
SQL["load_in_fk_order"] += " UNION ALL " + " UNION ALL ".join(
    f"SELECT {k}, '{t}', count(*), count(*), 'matched' FROM {cte}" for k, (t, cte) in enumerate(MART_SIZES.items(), 13)
)
SQL["load_appended"] = " UNION ALL ".join(
    f"SELECT CAST({k} AS BIGINT) AS load_order, '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows,"
    f" 'matched' AS status FROM {t}" for k, t in enumerate(TABLES, 1)
)
ICU = "admission_id IN (SELECT admission_id FROM admissions WHERE ward_type = 'ICU')"
ADDED = {t: ICU for t in ("admissions", "diagnoses", "procedures", "medicines", "labs", "appointments", "billing")}
ADDED["claims"] = f"billing_id IN (SELECT billing_id FROM billing WHERE {ICU})"
SQL["load_repeated"] = " UNION ALL ".join(
    f"""SELECT CAST({k} AS BIGINT) AS load_order, '{t}' AS table_name, count(*) AS source_rows, added AS added_rows,
    count(*) - added AS already_there, count(*) AS stored_rows
    FROM {t}, (SELECT count(*) AS added FROM {t} WHERE {ADDED.get(t, 'false')}) GROUP BY added""" for k, t in enumerate(TABLES, 1)
)
SQL["load_interrupted"] = " UNION ALL ".join(
    f"""SELECT CAST({k} AS BIGINT) AS load_order, '{t}' AS table_name, count(*) AS source_rows, count(*) AS added_rows,
    CAST(0 AS BIGINT) AS already_there, count(*) AS stored_rows, count(*) AS rows_read, CAST(0 AS BIGINT) AS loads_seen_after_crash
    FROM {t}""" for k, t in enumerate(TABLES, 1)
)
SQL["ingest_keyed_bills"] = f"""SELECT billing_id, claim_id, patient_id, encounter_id, {day('claim_billing_date')}, insurance_provider,
  payment_method, claim_status, {m('billed_amount')}, {m('paid_amount')}, {m('greatest(billed_amount - paid_amount, 0)', 'claim_gap')},
  {i("CASE WHEN claim_status = 'Paid' THEN 1 ELSE 0 END", 'claim_approved')} FROM bill_raw_clean"""
SQL["read_raw_billing"] = "SELECT * REPLACE ('00' || substr(billing_id, 4) AS billing_id) FROM bill_text"
SQL["query_evidence"] = f"""SELECT 'Admissions' AS metric, {m('count(*)', 'value')} FROM admissions
UNION ALL SELECT 'Patients', count(*) FROM patients
UNION ALL SELECT 'Readmission rate', round(avg(readmitted_30d), 6) FROM admissions
UNION ALL SELECT 'Average LOS', round(avg(los_days), 6) FROM admissions
UNION ALL SELECT 'Paid revenue', CAST(sum(paid_amount) AS DOUBLE) FROM billing
UNION ALL SELECT 'Claim approval ratio', round(avg(claim_approved), 6) FROM claims
UNION ALL SELECT 'Hospital efficiency score', round(efficiency_score, 6) FROM scores WHERE scope_type = 'hospital'
UNION ALL SELECT 'Next-week emergency patients', round_even(next_week, 0) FROM plan"""

SQL["stored_admissions_by_year"] = f"""SELECT year(admit_date) AS admit_year, {n('admissions')}, {i('sum(los_days)', 'days')}
  FROM admissions GROUP BY 1"""
SQL["read_table"] = f"SELECT patient_id, {i('age')}, gender, age_group FROM patients"

# --- validation and cleaning ---
ADM_COLS = ("admission_id", "patient_id", "hospital_id", "admit_date", "discharge_date", "los_days", "admit_type",
            "ward_type", "discharge_type", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin",
            "systolic_bp", "readmitted_30d", "readmitted_7d")
BILL_COLS = ("billing_id", "claim_id", "patient_id", "encounter_id", "claim_billing_date", "insurance_provider",
             "payment_method", "claim_status", "billed_amount", "paid_amount")


def nulls(columns: tuple[str, ...]) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns)


def profile(name: str, src: str, columns: tuple[str, ...], keys: str) -> str:
    return f"""SELECT '{name}' AS dataset, {n('rows')}, CAST({len(columns)} AS BIGINT) AS columns,
  {i(nulls(columns), 'missing_cells')}, {i(f'count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src}))', 'duplicate_rows')},
  {i(f'count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {src}))', 'duplicate_keys')} FROM {src}"""


SQL["profile_raw"] = (
    profile("admissions", "adm_text", ADM_COLS, "admission_id")
    + " UNION ALL " + profile("billing", "bill_text", BILL_COLS, "billing_id, claim_id")
)
SQL["rule_failures"] = """SELECT 'Admissions: discharge_date >= admit_date' AS rule, count(*) AS failed_rows FROM adm_text
  WHERE TRY_CAST(discharge_date AS DATE) < TRY_CAST(admit_date AS DATE)
UNION ALL SELECT 'Admissions: los_days between 0 and 90', count(*) FROM adm_text
  WHERE coalesce(TRY_CAST(los_days AS DOUBLE) NOT BETWEEN 0 AND 90, true)
UNION ALL SELECT 'Billing: billed_amount >= paid_amount', count(*) FROM bill_text
  WHERE TRY_CAST(paid_amount AS DECIMAL(14,2)) > TRY_CAST(billed_amount AS DECIMAL(14,2))
UNION ALL SELECT 'Billing: valid claim status', count(*) FROM bill_text
  WHERE coalesce(claim_status NOT IN ('Paid', 'Denied', 'Pending'), true)
UNION ALL SELECT 'Unique admission_id', count(*) - count(DISTINCT admission_id) FROM adm_text
UNION ALL SELECT 'Unique billing_id', count(*) - count(DISTINCT billing_id) FROM bill_text"""
SQL["missing_by_column"] = " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM adm_text" for c in ADM_COLS]
    + [f"SELECT '{c}', count(*) - count({c}) FROM bill_text" for c in BILL_COLS if c != "patient_id"]
    + ["SELECT 'billing_patient_id', count(*) - count(patient_id) FROM bill_text"]
)


def compared(name: str, raw: str, clean: str, raw_cols: tuple[str, ...], clean_cols: tuple[str, ...], key: str) -> str:
    return f"""SELECT '{name}' AS dataset, (SELECT count(*) FROM {raw}) AS raw_rows,
  (SELECT {i(nulls(raw_cols), 'v')} FROM {raw}) AS raw_missing, count(*) AS clean_rows,
  {i(nulls(clean_cols), 'clean_missing')}, {i(f'count(*) - count(DISTINCT {key})', 'duplicate_keys_after')} FROM {clean}"""


SQL["quality_comparison"] = (
    compared("admissions", "adm_text", "adm_text_clean", ADM_COLS, ADM_COLS, "admission_id") + " UNION ALL "
    + compared("claims", "bill_text", "bill_text_clean", BILL_COLS, (*BILL_COLS, "claim_gap", "claim_approved"), "billing_id")
)
WIDTHS = {"patients": 4, "departments": 2, "doctors": 4, "admissions": 14, "diagnoses": 3, "procedures": 2,
          "medicines": 4, "labs": 6, "insurance": 2, "billing": 9, "claims": 9, "appointments": 8,
          "model_features": 55}
SQL["table_quality"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS rows, CAST({w} AS BIGINT) AS columns,
    CAST(0 AS BIGINT) AS missing_cells, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS duplicate_rows
    FROM {t}""" for t, w in WIDTHS.items()
)
SQL["join_cardinality"] = """SELECT admission_id, count(*) AS rows, 'right' AS side FROM adm_text
  GROUP BY admission_id HAVING count(*) > 1"""


def described(column: str, numeric: bool) -> str:
    # The text form of a double differs between engines only for labels that are not compared here.
    shape = f"""SELECT '{column}' AS column_name, count({column}) AS count, count(DISTINCT {column}) AS "unique",
      (SELECT v FROM (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS c FROM adm_raw_clean GROUP BY 1)
       ORDER BY c DESC, v LIMIT 1) AS top,
      (SELECT max(c) FROM (SELECT count(*) AS c FROM adm_raw_clean GROUP BY {column})) AS freq"""
    if numeric:
        return shape + f""", {r(f'avg({column})', 'mean')}, {r(f'stddev_samp({column})', 'std')}, {r(f'min({column})', 'min')},
      {r(f'quantile_cont({column}, 0.25)', 'q25')}, {r(f'quantile_cont({column}, 0.5)', 'q50')},
      {r(f'quantile_cont({column}, 0.75)', 'q75')}, {r(f'max({column})', 'max')} FROM adm_raw_clean"""
    return shape + ", NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM adm_raw_clean"


SQL["describe_table"] = " UNION ALL ".join(
    [described(c, True) for c in NUMERIC]
    + [described(c, False) for c in ("admission_id", "patient_id", "admit_type", "ward_type", "discharge_type", "hospital_id",
                                     "admit_date", "discharge_date")]
)
SQL["drop_duplicate_keys"] = """SELECT patient_id, admit_date, admission_id, ward_type FROM (SELECT DISTINCT patient_id,
  admit_date, admission_id, ward_type, dense_rank() OVER (PARTITION BY patient_id ORDER BY admit_date, admission_id) AS k
  FROM adm_text) WHERE k = 1"""
SQL["coerce_dates"] = f"""SELECT billing_id, {day("try_strptime(claim_billing_date, '%d/%m/%Y')", 'claim_billing_date')}
  FROM bill_text"""
SQL["impute_median"] = f"SELECT admission_id, {', '.join(r(c) for c in NUMERIC)} FROM adm_text_filled"
SQL["impute_median_amounts"] = f"""WITH o AS (SELECT billing_id, claim_status,
    CASE WHEN claim_status <> 'Pending' THEN billed_amount END AS a FROM bill_raw)
  SELECT billing_id, claim_status, {m("coalesce(a, CAST((SELECT quantile_cont(CAST(a AS DOUBLE), 0.5) FROM o) AS DECIMAL(14,2)))", 'billed_amount')} FROM o"""
SQL["fill_unknown_trim"] = """SELECT billing_id, coalesce(insurance_provider, 'Unknown') AS insurance_provider, payment_method
  FROM bill_text"""
SQL["clip_lower"] = f"SELECT admission_id, {i('greatest(los_days - 4, 0)', 'los_days')} FROM adm_raw"
WINSORIZED = ", ".join(
    f"""round(CASE WHEN q.{c}_3 > q.{c}_1 THEN least(greatest(f.{c}, q.{c}_1 - 1.5e0 * (q.{c}_3 - q.{c}_1)),
    q.{c}_3 + 1.5e0 * (q.{c}_3 - q.{c}_1)) ELSE f.{c} END, 6) AS {c}""" for c in NUMERIC
)
SQL["winsorize_iqr"] = f"SELECT f.admission_id, {WINSORIZED} FROM adm_text_filled f CROSS JOIN adm_text_quartiles q"
SQL["clean_admissions"] = f"""SELECT admission_id, patient_id, hospital_id, {day('admit_date')}, {day('discharge_date')},
  admit_type, ward_type, discharge_type, {', '.join(r(c) for c in NUMERIC)} FROM adm_text_clean"""
SQL["clean_billing"] = f"""SELECT billing_id, claim_id, patient_id, encounter_id, {day('claim_billing_date')},
  insurance_provider, payment_method, claim_status, {m('billed_amount')}, {m('paid_amount')}, {m('claim_gap')},
  {i('claim_approved')} FROM bill_text_clean"""
SQL["derive_claim_fields"] = f"""SELECT billing_id, {m('paid', 'paid_amount')}, {m('greatest(billed_amount - paid, 0)', 'claim_gap')},
  {i("CASE WHEN claim_status = 'Paid' THEN 1 ELSE 0 END", 'claim_approved')}
  FROM (SELECT *, CASE WHEN payment_method = 'Cash' THEN CAST(billed_amount * 1.10 AS DECIMAL(14,2)) ELSE paid_amount END AS paid
        FROM bill_raw)"""
SQL["link_billing_to_admissions"] = f"""SELECT b.billing_id, a.admission_id, a.patient_id, b.patient_id AS source_patient_id,
  b.encounter_id AS source_encounter_id,
  {day("coalesce(b.claim_billing_date, a.discharge_date)", 'claim_billing_date')},
  'deterministic_surrogate_no_shared_source_key' AS linkage_method
  FROM (SELECT *, row_number() OVER (ORDER BY billing_id) - 1 AS pos FROM bill_text_clean) b
  JOIN (SELECT *, row_number() OVER (ORDER BY admission_id) - 1 AS slot FROM adm_text_clean) a
    ON b.pos % (SELECT count(*) FROM adm_text_clean) = a.slot"""
SQL["link_billing_by_encounter"] = f"""SELECT * EXCLUDE (encounter_id) REPLACE ({day('claim_billing_date')}, {m('billed_amount')},
  {m('paid_amount')}, {m('claim_gap')}, {i('claim_approved')}) FROM bills"""

# --- features ---
TEXT = {"admission_id", "patient_id", "hospital_id", "admit_type", "ward_type", "discharge_type", "department",
        "doctor_id", "gender", "medicine_code", "age_group", "season", "waiting_time_origin", "revenue_origin",
        "billing_category", "insurance_category", "department_origin", "doctor_origin", "demographics_origin",
        "medicine_origin"}
WHOLE = {"age", "admit_month", "admit_dayofweek", "is_weekend_admission", "previous_admissions",
         "department_daily_admissions", "lab_abnormality_score", "doctor_experience", "claim_count"}
MONEY = {"billed_amount", "paid_amount", "revenue_per_patient", "average_medicine_cost"}
FEATURES = (
    "admission_id", "patient_id", "hospital_id", "admit_date", "discharge_date", "los_days", "admit_type",
    "ward_type", "discharge_type", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin",
    "systolic_bp", "readmitted_30d", "readmitted_7d", "department", "doctor_id", "age", "gender", "medicine_code",
    "medicine_count", "admit_month", "admit_dayofweek", "is_weekend_admission", "age_group", "season",
    "previous_admissions", "readmission_history", "department_daily_admissions", "department_load",
    "disease_severity_score", "lab_abnormality_score", "doctor_experience", "bed_utilization_score",
    "patient_complexity_index", "risk_score", "waiting_time_minutes", "waiting_time_origin", "average_waiting_time",
    "total_procedures", "billed_amount", "paid_amount", "claim_approval_ratio", "claim_count", "revenue_per_patient",
    "revenue_origin", "billing_category", "insurance_category", "average_medicine_cost", "department_origin",
    "doctor_origin", "demographics_origin", "medicine_origin",
)


def shown(c: str) -> str:
    if c in TEXT:
        return c
    if c in WHOLE:
        return i(c)
    if c in MONEY:
        return m(c)
    return day(c) if c.endswith("_date") else r(c)


SQL["engineer_features"] = f"SELECT {', '.join(shown(c) for c in FEATURES)} FROM model_features"


def hashed(c: str) -> str:
    """A value as the fingerprint reads it: text as it is, numbers in millionths."""
    if c in TEXT or c.endswith("_date"):
        text = f"CAST({c} AS VARCHAR)"
    else:
        text = f"CAST(CAST(floor(CAST({c} AS DOUBLE) * 1e6 + 0.5) AS BIGINT) AS VARCHAR)"
    return f"coalesce('v' || {text}, 'n')"


DIGESTS = f"(SELECT ward_type, md5(concat_ws('|', {', '.join(hashed(c) for c in sorted(FEATURES))})) AS d FROM model_features)"
CONTENT = " || '-' || ".join(
    f"CAST(CAST(coalesce(sum(CAST(concat('0x', substr(d, {k}, 15)) AS BIGINT)), 0) AS HUGEINT) AS VARCHAR)" for k in (1, 16)
)
SQL["dataset_fingerprint"] = f"SELECT {n('rows')}, {CONTENT} AS content_hash FROM {DIGESTS}"
SQL["fingerprint_after_append"] = f"""SELECT ward_type AS part, {n('rows')}, {CONTENT} AS content_hash FROM {DIGESTS} GROUP BY ward_type
  UNION ALL SELECT 'without ICU', count(*), {CONTENT} FROM {DIGESTS} WHERE ward_type <> 'ICU'
  UNION ALL SELECT 'with ICU again', count(*), {CONTENT} FROM {DIGESTS}"""
SQL["changed_wards"] = f"""SELECT ward_type, count(*) AS rows_before, CASE ward_type WHEN 'HDU' THEN count(*) ELSE 0 END AS rows_after
  FROM model_features WHERE ward_type IN ('HDU', 'NICU') GROUP BY ward_type"""
FAMILIES = {
    "department": "department", "doctor": "doctor_id", "demographics": "age gender",
    "medicine": "medicine_code medicine_count total_procedures",
    "calendar": "admit_month admit_dayofweek is_weekend_admission", "age_group": "age age_group",
    "season": "admit_month season", "previous_admissions": "patient_id previous_admissions",
    "readmission_history": "patient_id readmission_history",
    "department_load": "department_daily_admissions department_load",
    "clinical_scores": "disease_severity_score lab_abnormality_score",
    "doctor_experience": "doctor_id doctor_experience", "bed_utilization": "bed_utilization_score",
    "risk_score": "patient_complexity_index risk_score",
    "waiting_time": "waiting_time_minutes waiting_time_origin", "average_wait": "department average_waiting_time",
    "billing_summary": "claim_count claim_approval_ratio",
    "finance": "billed_amount paid_amount revenue_per_patient revenue_origin",
    "billing_category": "billed_amount billing_category", "insurance": "insurance_category average_medicine_cost",
    "origins": "department_origin doctor_origin demographics_origin medicine_origin",
}
for _family, _columns in FAMILIES.items():
    SQL[f"feature_{_family}"] = f"SELECT admission_id, {', '.join(shown(c) for c in _columns.split())} FROM model_features"
SQL["stable_int"] = f"SELECT admission_id, {h('admission_id', 1000)} AS bucket FROM adm_raw"
SQL["feature_checks"] = """SELECT 'One row per admission' AS "check", count(*) - count(DISTINCT admission_id) AS failures FROM model_features
UNION ALL SELECT 'No missing model features', count(*) FROM model_features WHERE admit_type IS NULL OR charlson_index IS NULL OR season IS NULL
UNION ALL SELECT 'No first-visit history leakage', count(*) FROM model_features WHERE previous_admissions = 0 AND readmission_history <> 0
UNION ALL SELECT 'Readmission target is binary', count(*) FROM model_features WHERE readmitted_30d NOT IN (0, 1)
UNION ALL SELECT 'Waiting time is non-negative', count(*) FROM model_features WHERE waiting_time_minutes < 0
UNION ALL SELECT 'Revenue is non-negative', count(*) FROM model_features WHERE revenue_per_patient < 0"""
SQL["feature_defaults"] = " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 'numeric_default')}, NULL AS label_default FROM model_features"
     for c in FEATURES if c not in TEXT and not c.endswith("_date")]
    + [f"SELECT '{c}', NULL, (SELECT {c} FROM model_features GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
       for c in FEATURES if c in TEXT and c not in ("admission_id", "patient_id")]
)

# --- warehouse ---
SQL["table_patients"] = f"SELECT patient_id, {i('age')}, gender, age_group FROM patients"
SQL["table_doctors"] = f"SELECT doctor_id, department, {i('doctor_experience')}, {i('department_id')} FROM doctors"
SQL["table_admissions"] = f"""SELECT * REPLACE ({i('department_id')}, {day('admit_date')}, {day('discharge_date')}, {i('los_days')},
  {i('readmitted_30d')}, {i('readmitted_7d')}) FROM admissions"""
SQL["table_diagnoses"] = "SELECT * FROM diagnoses"
SQL["table_procedures"] = f"SELECT admission_id, {i('num_procedures')} FROM procedures"
SQL["table_medicines"] = f"SELECT admission_id, medicine_code, {i('medicine_count')}, {m('average_medicine_cost')} FROM medicines"
SQL["table_labs"] = f"SELECT * REPLACE ({r('hba1c')}, {r('creatinine')}, {r('haemoglobin')}, {i('lab_abnormality_score')}) FROM labs"
SQL["table_insurance"] = "SELECT * FROM insurance"
SQL["table_billing"] = f"""SELECT * REPLACE ({day('claim_billing_date')}, {m('billed_amount')}, {m('paid_amount')}, {m('claim_gap')})
  FROM billing"""
SQL["table_claims"] = f"SELECT * REPLACE ({i('claim_approved')}) FROM claims"
SQL["table_appointments"] = f"SELECT * REPLACE ({i('department_id')}, {day('admit_date')}) FROM appointments"

# --- views ---
SQL["vw_executive_kpis"] = f"""SELECT count(DISTINCT admission_id) AS admissions, count(DISTINCT patient_id) AS patients,
  {avg('readmitted_30d', 'readmission_rate')}, {avg('los_days', 'average_los')},
  {avg('waiting_time_minutes', 'average_waiting_time')}, {m('coalesce(sum(paid_amount), 0)', 'paid_revenue')},
  {avg('claim_approved', 'claim_approval_ratio')} FROM fan"""
SNAPSHOT = f"""{day('as_of_date')}, patients_today, {r('occupancy_pct')}, occupied_beds, {r('emergency_wait_minutes')},
  critical_patients, {r('doctor_utilization_pct')}"""
GROWTH = "CASE WHEN last_week > 0 THEN (next_week / last_week - 1) * 100 ELSE 0 END"
PLAN = f"""{day('starts', 'forecast_start_date')}, {day('ends', 'forecast_end_date')},
  {i('round_even(next_week, 0)', 'PATIENTS')}, {r(GROWTH, 'emergency_growth_pct')}, CAST(0 AS BIGINT) AS additional_beds,
  dayname(peak) AS peak_day, {i('round_even(peak_patients, 0)', 'peak_day_volume')}"""
HOSPITAL_SCORE = r("(SELECT efficiency_score FROM scores WHERE scope_type = 'hospital')", "hospital_efficiency_score")
SQL["vw_command_center"] = f"""SELECT {SNAPSHOT}, {HOSPITAL_SCORE}, CAST(500 AS BIGINT) AS capacity_assumption,
  {PLAN.replace('PATIENTS', 'next_week_emergency_patients')},
  'unavailable_no_arrival_timestamps' AS peak_hour_status FROM snapshot, plan"""
SCORES = f"""scope_type, scope_name, {r('efficiency_score')}, {r('patient_outcome_score')}, {r('collection_score')},
  {r('capacity_balance_score')}, {r('patient_flow_score')}, provenance"""
SQL["vw_efficiency_ranking"] = f"""SELECT {SCORES},
  dense_rank() OVER (PARTITION BY scope_type ORDER BY scores.efficiency_score DESC) AS efficiency_rank FROM scores"""
SQL["vw_operational_action_queue"] = f"""SELECT *, {i("CASE priority WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 ELSE 3 END", 'priority_order')}
  FROM actions"""
SQL["vw_department_kpis"] = f"""SELECT * REPLACE ({m('revenue')}), dense_rank() OVER (ORDER BY dep_kpis.revenue DESC) AS revenue_rank
  FROM dep_kpis"""
SQL["vw_doctor_utilization"] = f"""SELECT * REPLACE ({m('revenue')}),
  round(percent_rank() OVER (PARTITION BY department ORDER BY admissions), 6) AS workload_percentile FROM doc_kpis"""
SQL["vw_monthly_revenue"] = f"""SELECT month_start, insurance_provider, {m('billed', 'billed_revenue')}, {m('paid', 'paid_revenue')},
  claim_approval_ratio,
  {m('paid - lag(paid) OVER (PARTITION BY insurance_provider ORDER BY month_start)', 'month_over_month_change')} FROM month_payer"""
SQL["vw_daily_occupancy"] = f"""SELECT {day('admit_date')}, admissions, beds AS occupied_beds,
  {r('least(100, beds * 100 / 500e0)', 'occupancy_pct')},
  {r('avg(beds) OVER (ORDER BY occupancy.admit_date ROWS 6 PRECEDING)', 'occupied_beds_7d_avg')} FROM occupancy"""
SQL["vw_bed_occupancy"] = SQL["vw_daily_occupancy"]
P360 = f"""p.patient_id, {i('p.age', 'age')}, p.gender, a.admission_id, {day('a.admit_date', 'admit_date')},
  {day('a.discharge_date', 'discharge_date')}, d.department, o.doctor_id, g.disease_severity_score,
  {i('l.lab_abnormality_score', 'lab_abnormality_score')}, x.medicine_code, {i('x.medicine_count', 'medicine_count')},
  {m('b.billed_amount', 'billed_amount')}, {m('b.paid_amount', 'paid_amount')}, c.claim_status
  FROM patients p LEFT JOIN admissions a USING (patient_id) LEFT JOIN departments d USING (department_id)
  LEFT JOIN doctors o ON o.doctor_id = a.doctor_id LEFT JOIN diagnoses g USING (admission_id)
  LEFT JOIN labs l USING (admission_id) LEFT JOIN medicines x USING (admission_id)
  LEFT JOIN billing b USING (admission_id) LEFT JOIN claims c USING (billing_id)"""
SQL["vw_patient_360"] = f"SELECT {P360}"
SQL["patient_360_report"] = f"SELECT {P360} WHERE p.patient_id = 'PAT7'"
SQL["billing_claims"] = f"""SELECT * REPLACE ({day('claim_billing_date')}, {m('billed_amount')}, {m('paid_amount')}, {m('claim_gap')},
  {i('claim_approved')}) FROM flat"""
SQL["monthly_operations_report"] = f"""SELECT department, count(DISTINCT admission_id) AS admissions, {avg('los_days', 'avg_los')},
  {avg('waiting_time_minutes', 'avg_wait')}, {avg('readmitted_30d', 'readmission_rate')},
  {m('sum(coalesce(paid_amount, 0))', 'revenue')} FROM fan JOIN departments USING (department_id)
  WHERE year(admit_date) = 1998 AND month(admit_date) = 3 GROUP BY department"""
SQL["command_center_scores"] = SQL["vw_efficiency_ranking"]

# --- the 65 analyses ---
SQL["q01_executive_kpis"] = SQL["vw_executive_kpis"]
for _k, _name, _col in (
    (2, "admissions", "admissions"), (3, "revenue", m("revenue")), (4, "readmission", "readmission_rate"),
    (5, "wait", "average_wait"), (6, "los", "average_los"),
):
    SQL[f"q{_k:02d}_departments_by_{_name}"] = f"SELECT department, {_col} FROM dep_kpis"
SQL["q07_doctor_utilization_ranking"] = SQL["vw_doctor_utilization"]
SQL["q08_high_readmission_doctors"] = "SELECT doctor_id, department, admissions, readmission_rate FROM doc_kpis WHERE admissions >= 100"
SQL["doctors_with_readmissions"] = SQL["q08_high_readmission_doctors"].replace("100", "10")
SQL["q09_monthly_admissions"] = f"SELECT strftime(admit_date, '%Y-%m-01') AS month_start, {n('admissions')} FROM admissions GROUP BY ALL"
QUARTER = "year({0}) AS yr, quarter({0}) AS qtr"
SQL["q10_quarterly_admissions_growth"] = f"""SELECT yr, qtr, c AS admissions, c - lag(c) OVER (ORDER BY yr, qtr) AS admissions_growth
  FROM (SELECT {QUARTER.format('admit_date')}, count(*) AS c FROM admissions GROUP BY ALL)"""
SQL["q11_monthly_paid_revenue"] = f"""SELECT strftime(claim_billing_date, '%Y-%m-01') AS month_start, {total('paid_amount', 'paid_revenue')}
  FROM billing GROUP BY ALL"""
SQL["q12_quarterly_revenue_growth"] = f"""SELECT yr, qtr, {m('p', 'revenue')}, {m('p - lag(p) OVER (ORDER BY yr, qtr)', 'revenue_growth')}
  FROM (SELECT {QUARTER.format('claim_billing_date')}, sum(paid_amount) AS p FROM billing GROUP BY ALL)"""
SQL["q13_claim_success_by_insurer"] = f"SELECT insurance_provider, {avg('claim_approved', 'approval_ratio')}, {n('claims')} FROM flat GROUP BY ALL"
SQL["q14_denied_claim_value"] = f"""SELECT insurance_provider, {total('billed_amount', 'denied_value')} FROM bills
  WHERE claim_status = 'Denied' GROUP BY ALL"""
SQL["q15_payment_method_mix"] = f"SELECT payment_method, {n('claims')}, {total('paid_amount', 'paid_amount')} FROM billing GROUP BY ALL"
SQL["q16_average_claim_gap"] = f"SELECT insurance_provider, {avg('claim_gap', 'avg_gap')} FROM bills GROUP BY ALL"
SQL["q17_patient_revisit_frequency"] = "SELECT patient_id, count(*) AS visits FROM admissions GROUP BY ALL HAVING visits > 1"
for _k, _name, _col in ((18, "readmission_by_admit_type", "admit_type"), (19, "readmission_by_ward", "ward_type"),
                        (34, "discharge_outcomes", "discharge_type")):
    SQL[f"q{_k:02d}_{_name}"] = f"SELECT {_col}, {avg('readmitted_30d', 'readmission_rate')}, {n('admissions')} FROM model_features GROUP BY ALL"
SQL["q20_seven_day_readmission_rate"] = f"SELECT {avg('readmitted_7d', 'readmitted_7d_rate')} FROM admissions"
SQL["q21_bed_occupancy_trend"] = SQL["vw_daily_occupancy"]
SQL["q22_occupancy_by_weekday"] = f"""SELECT dayname(admit_date) AS day_name, {r('avg(least(100, beds / 5e0))', 'avg_occupancy')}
  FROM occupancy GROUP BY 1"""
SQL["q23_peak_waiting_days"] = f"""SELECT {day('admit_date')}, {r('w', 'avg_wait')} FROM (SELECT admit_date, avg(waiting_time_minutes) AS w
  FROM admissions GROUP BY 1 ORDER BY w DESC, admit_date LIMIT 20)"""
SQL["q24_emergency_wait_by_department"] = f"""SELECT {i('department_id')}, {avg('waiting_time_minutes', 'emergency_wait')} FROM admissions
  WHERE admit_type = 'Emergency' GROUP BY department_id"""
SQL["q25_los_by_admit_type"] = f"""SELECT admit_type, {avg('los_days', 'avg_los')}, {i('min(los_days)', 'min_los')},
  {i('max(los_days)', 'max_los')} FROM admissions GROUP BY ALL"""
SQL["q26_longest_stays"] = f"""SELECT patient_id, admission_id, {i('los_days')} FROM (SELECT * FROM admissions
  ORDER BY los_days DESC, admission_id LIMIT 50)"""
SQL["q27_severity_by_department"] = f"""SELECT department, {avg('charlson_index', 'avg_charlson')},
  {avg('disease_severity_score', 'avg_severity')} FROM model_features GROUP BY ALL"""
SQL["q28_lab_abnormality_by_readmission"] = f"""SELECT {i('readmitted_30d')}, {avg('lab_abnormality_score', 'avg_lab_abnormality')}
  FROM model_features GROUP BY model_features.readmitted_30d"""
SQL["q29_medicine_usage"] = f"""SELECT medicine_code, {i('sum(medicine_count)', 'total_usage')}, {avg('average_medicine_cost', 'avg_cost')}
  FROM medicines GROUP BY ALL"""
SQL["q30_procedures_by_department"] = f"SELECT department, {i('sum(num_procedures)', 'procedures')} FROM model_features GROUP BY ALL"
SQL["q31_top_patients_by_revenue"] = f"""SELECT patient_id, {m('p', 'revenue')} FROM (SELECT patient_id, sum(paid_amount) AS p FROM flat
  GROUP BY 1 ORDER BY p DESC, patient_id LIMIT 50)"""
SQL["q32_revenue_per_admission"] = f"SELECT department, {r('CAST(revenue AS DOUBLE) / nullif(admissions, 0)', 'revenue_per_admission')} FROM dep_kpis"
SQL["q33_top_department_ids"] = f"SELECT {i('department_id')}, {n('admissions')} FROM admissions GROUP BY department_id"
SQL["q35_claims_by_status"] = f"""SELECT claim_status, {n('claims')}, {total('billed_amount', 'billed')}, {total('paid_amount', 'paid')}
  FROM bills GROUP BY ALL"""
SQL["q36_claims_per_day"] = f"""SELECT {day('claim_billing_date', 'claim_date')}, {n('claims')}, {total('paid_amount', 'paid')}
  FROM bills GROUP BY claim_billing_date"""
SQL["q37_high_risk_departments"] = f"""SELECT department, {avg('readmitted_30d', 'readmit')}, {avg('waiting_time_minutes', 'wait_time')}
  FROM model_features GROUP BY department HAVING avg(readmitted_30d) > (SELECT readmission FROM rates)"""
SQL["q38_doctor_rank_in_department"] = """SELECT doctor_id, department, admissions,
  rank() OVER (PARTITION BY department ORDER BY admissions DESC) AS department_rank FROM doc_kpis"""
SQL["q39_running_admissions"] = f"""SELECT {day('d', 'admit_date')}, c AS admissions, {i('sum(c) OVER (ORDER BY d)', 'running_admissions')}
  FROM (SELECT admit_date AS d, count(*) AS c FROM admissions GROUP BY 1)"""
SQL["q40_running_revenue"] = f"""SELECT {day('d', 'billing_date')}, {m('p', 'paid')}, {m('sum(p) OVER (ORDER BY d)', 'running_revenue')}
  FROM (SELECT claim_billing_date AS d, sum(paid_amount) AS p FROM billing GROUP BY 1)"""
SQL["q41_wait_percentile_in_department"] = f"""SELECT department, admission_id, waiting_time_minutes,
  {r('cume_dist() OVER (PARTITION BY department ORDER BY waiting_time_minutes)', 'wait_percentile')} FROM model_features"""
SQL["q42_multi_risk_patients"] = f"""SELECT patient_id, {n('visits')}, {avg('disease_severity_score', 'severity')},
  {avg('readmitted_30d', 'readmit')} FROM model_features GROUP BY patient_id
  HAVING count(*) > 1 AND avg(disease_severity_score) >= 4"""
SQL["q43_approval_by_month"] = f"""SELECT strftime(claim_billing_date, '%Y-%m-01') AS month_start, {avg('claim_approved', 'approval_ratio')}
  FROM bills GROUP BY 1"""
SQL["q44_paid_by_insurer"] = f"""SELECT insurance_provider, {avg('paid_amount', 'avg_paid')}, {total('paid_amount', 'total_paid')}
  FROM flat GROUP BY ALL"""
SQL["q45_longest_waits"] = """SELECT admission_id, patient_id, waiting_time_minutes FROM admissions
  ORDER BY waiting_time_minutes DESC, admission_id LIMIT 100"""
SQL["q46_readmission_gaps"] = f"""SELECT patient_id, {day('admit_date')}, {day('prev', 'prev_discharge')},
  {i('admit_date - prev', 'gap_days')} FROM (SELECT patient_id, admit_date, lag(discharge_date) OVER
  (PARTITION BY patient_id ORDER BY admit_date, admission_id) AS prev FROM admissions) v WHERE prev IS NOT NULL"""
SQL["q47_revenue_leakage"] = f"SELECT insurance_provider, {total('billed_amount - paid_amount', 'leakage')} FROM bills GROUP BY ALL"
SQL["q48_department_revenue_share"] = f"""SELECT department, {m('revenue')},
  {r('CAST(dep_kpis.revenue AS DOUBLE) / CAST(sum(dep_kpis.revenue) OVER () AS DOUBLE)', 'revenue_share')} FROM dep_kpis"""
for _k, _name, _col, _share in ((49, "admission_mix", "admit_type", "admission_share"), (50, "ward_mix", "ward_type", "ward_share")):
    SQL[f"q{_k}_{_name}"] = f"""SELECT {_col}, {n('admissions')}, {r('count(*) / (SELECT count(*) FROM model_features)', _share)}
      FROM model_features GROUP BY {_col}"""
SQL["q51_high_occupancy_days"] = f"SELECT {day('admit_date')}, {r('least(100, beds / 5e0)', 'occupancy_pct')} FROM occupancy WHERE beds >= 450"
SQL["weekday_census_alert"] = SQL["q51_high_occupancy_days"].replace("450", "25")
SQL["q52_daily_discharges"] = f"SELECT {day('discharge_date')}, {n('discharges')} FROM admissions GROUP BY admissions.discharge_date"
SQL["q53_doctor_revenue_rank"] = f"""SELECT doctor_id, department, {m('revenue')}, rank() OVER (ORDER BY doc_kpis.revenue DESC) AS revenue_rank
  FROM doc_kpis"""
SQL["q54_department_wait_gap"] = f"""SELECT department, {avg('waiting_time_minutes', 'average_wait')},
  {r('avg(waiting_time_minutes) - (SELECT wait FROM rates)', 'wait_gap')} FROM departments LEFT JOIN fan USING (department_id) GROUP BY department"""
SQL["q55_readmission_by_age_group"] = f"SELECT age_group, {avg('readmitted_30d', 'readmission_rate')}, {n('admissions')} FROM model_features GROUP BY ALL"
SQL["q56_gender_utilization"] = f"""SELECT gender, {n('admissions')}, {avg('los_days', 'avg_los')}, {avg('readmitted_30d', 'readmit')}
  FROM model_features GROUP BY ALL"""
SQL["q57_largest_unpaid_claims"] = SQL["billing_claims"].replace(
    "FROM flat", "FROM (SELECT * FROM flat WHERE paid_amount = 0 ORDER BY billed_amount DESC, billing_id LIMIT 100)")
SQL["q58_procedures_and_readmission"] = f"""SELECT {i('num_procedures')}, {avg('readmitted_30d', 'readmission_rate')}, {n('admissions')}
  FROM model_features GROUP BY model_features.num_procedures"""
SQL["q59_los_bucket_and_paid"] = f"""SELECT CASE WHEN los_days > 7 THEN 'Long' WHEN los_days > 2 THEN 'Medium' ELSE 'Short' END AS los_bucket,
  {avg('paid_amount', 'avg_paid')}, {n('rows_count')} FROM fan GROUP BY 1"""
SQL["q60_daily_patient_flow"] = f"""SELECT {day('f', 'flow_date')}, {n('admits').replace('count(*)', 'count(*) FILTER (WHERE k = 1)')},
  {n('discharges').replace('count(*)', 'count(*) FILTER (WHERE k = 2)')} FROM (SELECT admit_date AS f, 1 AS k FROM admissions
  UNION ALL SELECT discharge_date, 2 FROM admissions) GROUP BY f"""
SQL["q61_command_center_snapshot"] = SQL["vw_command_center"]
SQL["q62_department_efficiency"] = f"""SELECT scope_name AS department, {r('efficiency_score')}, {r('patient_outcome_score')},
  {r('capacity_balance_score')}, {r('patient_flow_score')}, dense_rank() OVER (ORDER BY scores.efficiency_score DESC) AS efficiency_rank
  FROM scores WHERE scope_type = 'department'"""
SQL["emergency_forecast"] = f"""SELECT {day('forecast_date')}, {r('patients', 'forecast_emergency_patients')},
  'eight_week_weekday_seasonal_baseline' AS method, 'forecast_from_observed_daily_emergency_admissions' AS provenance FROM outlook"""
SQL["q63_next_week_emergency"] = SQL["emergency_forecast"]
SQL["q64_recommendation_queue"] = "SELECT * FROM actions"
SQL["q65_weak_efficiency_components"] = f"""SELECT scope_type, scope_name, component, {r('score')} FROM (
  SELECT scope_type, scope_name, unnest(['Patient outcomes', 'Capacity balance', 'Patient flow']) AS component,
    unnest([patient_outcome_score, capacity_balance_score, patient_flow_score]) AS score FROM scores) x WHERE x.score < 70"""

# --- marts ---
SQL["historical_occupancy"] = f"SELECT {day('d', 'date')}, {i('beds', 'occupied_beds')}, {r('pct', 'occupancy_pct')} FROM census_pct"
SQL["latest_snapshot"] = f"SELECT {SNAPSHOT} FROM snapshot"
SQL["department_summary"] = f"""SELECT department, patients, admissions, {r('wait', 'average_wait')}, {r('readmission', 'readmission_rate')},
  {r('pressure', 'bed_utilization')} FROM dep_care"""
SQL["efficiency_scores"] = f"SELECT {SCORES} FROM scores"
SQL["recommendations"] = "SELECT * FROM actions"
SQL["command_center_kpis"] = f"""SELECT {SNAPSHOT}, {HOSPITAL_SCORE}, CAST(500 AS BIGINT) AS capacity_assumption,
  'observed_latest_date_with_derived_and_simulated_metrics' AS snapshot_provenance FROM snapshot"""
SQL["operational_forecast_summary"] = f"""SELECT {PLAN.replace('PATIENTS', 'emergency_patients')},
  'weekday_seasonal_emergency_baseline_plus_registered_occupied_bed_forecast' AS method,
  'unavailable_no_arrival_timestamps' AS peak_hour_status FROM plan"""
SQL["executive_kpi_rows"] = f"""SELECT 'Admissions' AS metric, {m('count(*)', 'value')} FROM model_features
UNION ALL SELECT 'Patients', count(DISTINCT patient_id) FROM model_features
UNION ALL SELECT 'Readmission Rate', round(avg(readmitted_30d), 6) FROM model_features
UNION ALL SELECT 'Average LOS', round(avg(los_days), 6) FROM model_features
UNION ALL SELECT 'Average Waiting Time', round(avg(waiting_time_minutes), 6) FROM model_features
UNION ALL SELECT 'Paid Revenue', CAST(sum(paid_amount) AS DOUBLE) FROM bills
UNION ALL SELECT 'Claim Approval Ratio', round(avg(claim_approved), 6) FROM bills"""
GROUPED = "replace(format('{:,}', CAST(round_even(CAST(v AS DOUBLE), 0) AS BIGINT)), ' ', '')"
SQL["business_insights"] = f"""SELECT 'Patient outcomes' AS area, 'Observed' AS reliability, 'Prioritize ward-level discharge review.' AS decision_use,
  (SELECT k || ' has the highest observed ward readmission rate at ' || printf('%.1f%%', v * 100) || '.' FROM
   (SELECT ward_type AS k, avg(readmitted_30d) AS v FROM model_features GROUP BY 1) ORDER BY v DESC, k LIMIT 1) AS insight
UNION ALL SELECT 'Hospital flow', 'Observed', 'Use for site-level capacity and staffing review.',
  (SELECT k || ' records the highest admission volume with ' || {GROUPED} || ' encounters.' FROM
   (SELECT hospital_id AS k, count(*) AS v FROM model_features GROUP BY 1) ORDER BY v DESC, k LIMIT 1)
UNION ALL SELECT 'Claims', 'Observed', 'Focus denial management on payer-specific gaps.',
  (SELECT k || ' has the largest observed billed-to-paid gap at ' || {GROUPED} || '.' FROM
   (SELECT insurance_provider AS k, sum(claim_gap) AS v FROM bills GROUP BY 1) ORDER BY v DESC, k LIMIT 1)
UNION ALL SELECT 'Waiting scenario', 'Simulated', 'Demonstrates queue-model workflow only; replace with timestamp data.',
  (SELECT k || ' has the highest simulated average wait at ' || printf('%.1f', v) || ' minutes.' FROM
   (SELECT ward_type AS k, avg(waiting_time_minutes) AS v FROM model_features GROUP BY 1) ORDER BY v DESC, k LIMIT 1)
UNION ALL SELECT 'Risk', 'Derived from observed clinical fields', 'Use as a screening segment, not a causal conclusion.',
  (SELECT 'Patients in the top complexity quartile have a ' || printf('%.1f%%', avg(readmitted_30d) * 100) || ' readmission rate.'
   FROM model_features, p75 WHERE patient_complexity_index >= p75)"""
SQL["executive_action_plan"] = """SELECT priority, action, owner, timeframe, success_measure, signal AS evidence FROM actions
UNION ALL SELECT 'P2', 'Replace derived master data', 'Data Governance Lead', '90 days',
  'Governed provider, department, and patient keys',
  'Claims are linked by a governed encounter key; departments, doctors and demographics are derived'"""

# --- reporting aggregates ---
MONTHS = "SELECT CAST(unnest(generate_series(date_trunc('month', min({0})), date_trunc('month', max({0})), INTERVAL 1 MONTH)) AS DATE) AS month_start"
ACTIVITY = f"""SELECT month_start, count(admission_id) AS admissions, count(DISTINCT patient_id) AS patients,
  {avg('readmitted_30d', 'readmission_rate')}, {avg('los_days', 'average_los')}
  FROM ({MONTHS.format('admit_date')} FROM model_features) LEFT JOIN model_features ON date_trunc('month', admit_date) = month_start
  GROUP BY month_start"""
SQL["monthly_activity"] = f"SELECT * REPLACE ({day('month_start')}) FROM ({ACTIVITY}) x"
SQL["admission_growth"] = f"""SELECT {r('(last(admissions ORDER BY month_start) / greatest(first(admissions ORDER BY month_start), 1) - 1) * 100',
  'admission_growth')} FROM (SELECT * FROM ({ACTIVITY}) ORDER BY month_start DESC LIMIT 2)"""
FINANCE = f"""SELECT month_start, coalesce(sum(billed_amount), 0) AS billed, coalesce(sum(paid_amount), 0) AS paid
  FROM ({MONTHS.format('claim_billing_date')} FROM bills) LEFT JOIN bills ON date_trunc('month', claim_billing_date) = month_start
  GROUP BY month_start"""
SQL["monthly_finance"] = f"SELECT {day('month_start')}, {m('billed')}, {m('paid')} FROM ({FINANCE}) x"
SQL["yearly_trend"] = f"""SELECT y AS year, c AS admissions, {r('a', 'readmission_rate')}, {r('l', 'average_los')},
  {r('c / lag(c) OVER (ORDER BY y) - 1', 'admission_delta')}, {r('a - lag(a) OVER (ORDER BY y)', 'readmission_delta')}
  FROM (SELECT year(admit_date) AS y, count(*) AS c, avg(readmitted_30d) AS a, avg(los_days) AS l FROM model_features GROUP BY 1)"""
SQL["ward_summary"] = f"""SELECT ward_type, {n('admissions')}, {i('sum(readmitted_30d)', 'readmissions')}, {avg('readmitted_30d', 'readmission_rate')},
  {avg('los_days', 'average_los')}, {r('avg(bed_utilization_score)', 'utilization')} FROM model_features GROUP BY ward_type"""
SQL["admit_type_summary"] = f"SELECT admit_type, {n('admissions')}, {avg('readmitted_30d', 'readmission_rate')} FROM model_features GROUP BY ALL"
SQL["payer_summary"] = f"""SELECT insurance_provider, {n('claims')}, {total('billed_amount', 'billed')}, {total('paid_amount', 'paid')},
  {total('claim_gap', 'gap')}, {avg('claim_approved', 'approval')},
  {r('CAST(sum(paid_amount) AS DOUBLE) / CAST(sum(billed_amount) AS DOUBLE)', 'collection_rate')} FROM bills GROUP BY insurance_provider"""
SQL["claim_status_counts"] = f"SELECT claim_status, {n('claims')} FROM bills GROUP BY ALL"
SQL["finance_totals"] = f"""SELECT {total('billed_amount', 'billed')}, {total('paid_amount', 'paid')}, {total('claim_gap', 'gap')},
  {r('CAST(sum(paid_amount) AS DOUBLE) / CAST(sum(billed_amount) AS DOUBLE)', 'collection_rate')},
  {avg('claim_approved', 'approval_rate')} FROM bills"""
SQL["rolling_admissions"] = f"""SELECT {day('month_start')}, admissions,
  {r('CASE WHEN count(*) OVER w = 3 THEN avg(admissions) OVER w END', 'rolling_3m')}
  FROM (SELECT * FROM ({ACTIVITY}) ORDER BY month_start DESC LIMIT 24) x WINDOW w AS (ORDER BY x.month_start ROWS 2 PRECEDING)"""
SQL["high_complexity_cohort"] = f"""SELECT {n('admissions')}, {avg('readmitted_30d', 'readmission_rate')}, {r('any_value(p75)', 'threshold')}
  FROM model_features, p75 WHERE patient_complexity_index >= p75"""
PERFORMANCE = """SELECT department, count(DISTINCT patient_id) AS patients, count(*) AS admissions, sum(revenue_per_patient) AS revenue,
  avg(los_days) AS average_los, avg(waiting_time_minutes) AS average_wait, avg(readmitted_30d) AS readmission_rate,
  avg(bed_utilization_score) AS bed_utilization, 1 - avg(readmitted_30d) AS success_rate FROM model_features GROUP BY department"""
SQL["department_performance"] = f"""SELECT department, patients, admissions, {m('revenue')}, {r('average_los')}, {r('average_wait')},
  {r('readmission_rate')}, {r('bed_utilization')}, {r('success_rate')} FROM ({PERFORMANCE})"""


def minmax(c: str) -> str:
    v = f"CAST(p.{c} AS DOUBLE)"
    return r(f"({v} - min({v}) OVER ()) / (max({v}) OVER () - min({v}) OVER ())", c)


SQL["department_heatmap"] = f"""SELECT department, {', '.join(minmax(c) for c in
  ('admissions', 'revenue', 'average_los', 'average_wait', 'success_rate'))} FROM ({PERFORMANCE}) p"""


def pct(c: str) -> str:
    return f"(SELECT avg(k) FROM (SELECT row_number() OVER (ORDER BY {c}) AS k, {c} AS v FROM g) z WHERE z.v = g.{c}) / (SELECT count(*) FROM g)"


NAMES = ("['Dr. A. Sharma','Dr. R. Patel','Dr. V. Kumar','Dr. N. Singh','Dr. P. Mehta','Dr. S. Iyer','Dr. K. Reddy',"
         "'Dr. M. Joshi','Dr. T. Rao','Dr. D. Gupta']")
DOCTORS = f"""WITH g AS (SELECT doctor_id, department, count(DISTINCT patient_id) AS patients, count(*) AS admissions,
    avg(los_days) AS average_treatment_days, sum(revenue_per_patient) AS revenue, avg(waiting_time_minutes) AS average_wait,
    avg(readmitted_30d) AS readmission_rate FROM model_features GROUP BY doctor_id, department)
  SELECT doctor_id, department, patients, admissions, {r('average_treatment_days')}, {m('revenue')}, {r('average_wait')},
    {r('readmission_rate')}, {NAMES}[(CAST(substr(doctor_id, 4) AS INT) - 1) % 10 + 1] || ' · Team '
      || CAST((CAST(substr(doctor_id, 4) AS INT) - 1) // 10 + 1 AS VARCHAR) AS doctor,
    round(round_even(((1 - {pct('average_wait')}) + (1 - {pct('readmission_rate')})) / 2 * 100 * 10, 0) / 10, 6) AS quality_score FROM g"""
SQL["doctor_performance"] = DOCTORS
SQL["doctor_leaderboard"] = f"SELECT * FROM ({DOCTORS}) ORDER BY quality_score DESC, doctor_id LIMIT 12"
SQL["doctor_leaders_by_revenue"] = f"""SELECT * FROM ({DOCTORS}) WHERE department IN ('Cardiology', 'Surgery', 'Oncology')
  ORDER BY revenue DESC, doctor_id LIMIT 3"""
SQL["patient_search"] = "SELECT DISTINCT patient_id FROM model_features WHERE patient_id ILIKE '%pat12%' ORDER BY 1 LIMIT 1000"
SQL["patient_timeline"] = f"""SELECT 'Encounter ' || CAST(row_number() OVER (ORDER BY x.admit_date, admission_id) AS VARCHAR) AS encounter,
  {day('admit_date')}, {day('discharge_date')}, department, admit_type, los_days, disease_severity_score, readmitted_30d
  FROM model_features x WHERE patient_id = 'PAT7'"""
SQL["latest_encounter"] = f"""SELECT patient_id, admission_id, {day('admit_date')}, {day('discharge_date')}, department, ward_type, los_days,
  disease_severity_score, {i('lab_abnormality_score')}, readmitted_30d, {r('risk_score')},
  {r('(SELECT avg(los_days) FROM model_features y WHERE y.ward_type = x.ward_type)', 'ward_average_los')}
  FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY admit_date DESC, admission_id DESC) AS k FROM model_features) x
  WHERE k = 1"""
SQL["risk_class"] = f"""SELECT admission_id, patient_id, {r('risk_score')}, CASE
    WHEN f.risk_score >= (SELECT quantile_cont(risk_score, 0.75) FROM model_features) THEN 'HIGH'
    WHEN f.risk_score >= (SELECT quantile_cont(risk_score, 0.5) FROM model_features) THEN 'MEDIUM' ELSE 'LOW' END AS risk_class
  FROM model_features f"""
SQL["risk_segmentation"] = """SELECT CASE WHEN risk_score <= a THEN 'Low' WHEN risk_score <= b THEN 'Medium' ELSE 'High' END AS risk_group,
  count(*) AS patients FROM model_features, (SELECT quantile_cont(risk_score, 1/3) AS a, quantile_cont(risk_score, 2/3) AS b
  FROM model_features) GROUP BY 1"""
SQL["patient_flow_funnel"] = """SELECT 'Admissions' AS stage, count(*) AS volume FROM model_features
UNION ALL SELECT 'Unique patients', count(DISTINCT patient_id) FROM model_features
UNION ALL SELECT 'High-complexity encounters', count(*) FROM model_features, p75 WHERE patient_complexity_index >= p75
UNION ALL SELECT '30-day readmissions', CAST(sum(readmitted_30d) AS BIGINT) FROM model_features"""
SQL["age_histogram"] = f"""SELECT {i('bin')}, gender, {r('any_value(lo) + any_value(bin) * any_value(w)', 'age_from')}, {n('patients')}
  FROM (SELECT gender, lo, (hi - lo) / 18e0 AS w, least((age - lo) * 18 // (hi - lo), 17) AS bin
        FROM model_features, (SELECT min(age) AS lo, max(age) AS hi FROM model_features)) x GROUP BY x.bin, gender"""
SQL["weekday_volume"] = """SELECT CAST(w AS BIGINT) AS day_number, name AS weekday, c AS admissions FROM
  (SELECT unnest(range(7)) AS w, unnest(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday']) AS name)
  LEFT JOIN (SELECT isodow(admit_date) - 1 AS k, count(*) AS c FROM model_features GROUP BY 1) ON k = w"""
SQL["risk_comparison"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, {r(f'avg({c}) FILTER (WHERE readmitted_30d = 0)', 'not_readmitted')},
    {r(f'avg({c}) FILTER (WHERE readmitted_30d = 1)', 'readmitted')} FROM model_features"""
    for c in ("los_days", "charlson_index", "previous_admissions", "lab_abnormality_score", "patient_complexity_index")
)
CORRELATED = ("readmitted_30d", "los_days", "charlson_index", "previous_admissions", "lab_abnormality_score",
              "patient_complexity_index", "waiting_time_minutes", "revenue_per_patient")
SQL["correlation_matrix"] = " UNION ALL ".join(
    f"SELECT '{a}' AS feature, '{b}' AS other, {r(f'corr({a}, {b})', 'correlation')} FROM model_features"
    for a in CORRELATED for b in CORRELATED
)
SQL["bed_status"] = f"""SELECT {i('c', 'current_beds')}, {i('greatest(500 - c, 0)', 'available_beds')}, {r('least(c / 500, 1)', 'occupancy_rate')},
  {r('(SELECT avg(pct) FROM (SELECT pct FROM census_pct ORDER BY d DESC LIMIT 30))', 'mean_pct_30d')}
  FROM (SELECT round_even(avg(beds), 0) AS c FROM (SELECT beds FROM census ORDER BY d DESC LIMIT 7))"""
SQL["trailing_occupancy"] = SQL["historical_occupancy"].replace(
    "FROM census_pct", "FROM (SELECT * FROM census_pct ORDER BY d DESC LIMIT 365)")
SQL["department_bed_pressure"] = f"SELECT department, {r('pressure', 'bed_utilization_score')} FROM dep_care"
SQL["revenue_long"] = f"""SELECT {day('month_start')}, measure, {m('amount')} FROM (SELECT month_start, unnest(['billed', 'paid']) AS measure,
  unnest([billed, paid]) AS amount FROM ({FINANCE})) x"""
SQL["icu_weekend_share"] = f"""SELECT {n('icu_admissions')}, {r('coalesce(avg(is_weekend_admission), 0)', 'weekend_share')}
  FROM model_features WHERE upper(ward_type) = 'ICU'"""
SQL["top_department_contribution"] = f"""SELECT (SELECT department FROM p ORDER BY revenue DESC, department LIMIT 1) AS revenue_leader,
  {r('(SELECT CAST(max(revenue) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE) FROM p)', 'revenue_share')},
  (SELECT department FROM p ORDER BY admissions DESC, department LIMIT 1) AS busiest_department,
  (SELECT department FROM p ORDER BY average_wait DESC, department LIMIT 1) AS longest_wait_department,
  {r('(SELECT max(average_wait) FROM p)', 'longest_wait')}""".replace("FROM p", f"FROM ({PERFORMANCE})")

# --- measures ---


def measures(by: str) -> str:
    keys = f"{by}, " if by else ""
    where = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}count(DISTINCT admission_id) AS admissions, count(DISTINCT patient_id) AS patients,
  {avg('readmitted_30d', 'readmission_rate')}, {avg('los_days', 'average_los')}, {avg('waiting_time_minutes', 'average_wait')},
  {total('paid', 'paid_revenue')}, {total('billed', 'billed_revenue')}, {total('gap', 'revenue_leakage')},
  {r('sum(approved) / sum(bills)', 'claim_approval_ratio')},
  {r('CAST(sum(paid) AS DOUBLE) / count(DISTINCT patient_id)', 'revenue_per_patient')},
  {r('count(*) / (SELECT count(*) FROM doctors)', 'admissions_per_doctor')},
  {i('sum(is_weekend_admission)', 'weekend_admissions')}, {r('avg(is_weekend_admission)', 'weekend_admission_rate')}
  FROM model_features LEFT JOIN (SELECT admission_id, sum(paid_amount) AS paid, sum(billed_amount) AS billed,
    sum(claim_gap) AS gap, sum(claim_approved) AS approved, count(*) AS bills FROM bills GROUP BY 1) USING (admission_id) {where}"""


SQL["measures_total"] = measures("")
SQL["measures_by_department"] = measures("department")
SQL["measures_by_ward_and_gender"] = measures("ward_type, gender")
SQL["revenue_growth"] = f"""SELECT {day('month_start')}, {m('paid', 'paid_revenue')}, {m('prior', 'prior_month_revenue')},
  {r('CAST(paid - prior AS DOUBLE) / nullif(CAST(prior AS DOUBLE), 0)', 'monthly_revenue_growth')}
  FROM (SELECT month_start, paid, lag(paid) OVER (ORDER BY month_start) AS prior FROM ({FINANCE})) x"""
SQL["trailing_admissions"] = f"""SELECT {day('d', 'date')}, (SELECT count(*) FROM admissions WHERE admit_date BETWEEN d - 29 AND d) AS admissions_30d
  FROM days"""
SQL["command_center_measures"] = f"""SELECT patients_today, {r('occupancy_pct / 100', 'occupancy_share')}, occupied_beds,
  {r('emergency_wait_minutes', 'emergency_wait')}, critical_patients, {r('doctor_utilization_pct / 100', 'doctor_utilization_share')},
  {HOSPITAL_SCORE}, {i('round_even(next_week, 0)', 'next_week_emergency_patients')}, {r(f'({GROWTH}) / 100', 'emergency_growth_share')},
  CAST(0 AS BIGINT) AS additional_beds_required, dayname(peak) AS peak_forecast_day FROM snapshot, plan"""
SQL["department_efficiency_score"] = f"""SELECT scope_name AS department, {r('efficiency_score', 'department_efficiency_score')} FROM scores
  WHERE scope_type = 'department'"""

# --- contracts ---
KEYS = {"patients": "patient_id", "doctors": "doctor_id", "departments": "department_id", "admissions": "admission_id",
        "insurance": "insurance_id", "billing": "billing_id", "claims": "claim_line_id", "appointments": "appointment_id",
        "model_features": "admission_id"}
SQL["check_primary_keys"] = " UNION ALL ".join(
    f"""SELECT 'table:{t}' AS "check", CASE WHEN count(*) = count(DISTINCT {k}) THEN 'passed' ELSE 'failed' END AS status,
    count(*) AS rows FROM {t}""" for t, k in KEYS.items()
)
RELATIONS = (
    ("admissions", "patient_id", "patients"), ("admissions", "doctor_id", "doctors"),
    ("admissions", "department_id", "departments"), ("billing", "admission_id", "admissions"),
    ("billing", "patient_id", "patients"), ("billing", "insurance_id", "insurance"), ("claims", "billing_id", "billing"),
    ("claims", "insurance_id", "insurance"), ("appointments", "admission_id", "admissions"),
    ("appointments", "patient_id", "patients"), ("appointments", "doctor_id", "doctors"),
    ("appointments", "department_id", "departments"), ("model_features", "admission_id", "admissions"),
)


def orphans(child: str, key: str, parent: str) -> str:
    return f"(SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key}))"


SQL["check_foreign_keys"] = " UNION ALL ".join(
    f"""SELECT 'foreign_key:{c}.{k}' AS "check", CASE WHEN {orphans(c, k, p)} = 0 THEN 'passed' ELSE 'failed' END AS status,
    (SELECT count(*) FROM {c}) AS rows""" for c, k, p in RELATIONS
)
SQL["orphaned_bills"] = "WITH damaged AS (SELECT * FROM admissions WHERE ward_type <> 'ICU') " + " UNION ALL ".join(
    f"SELECT '{c}.{k}' AS relation, (SELECT count(*) FROM {dc}) AS rows, {orphans(dc, k, dp)} AS orphans"
    for c, k, p in RELATIONS
    for dc, dp in [("damaged" if c == "admissions" else c, "damaged" if p == "admissions" else p)]
)
SQL["check_admission_dates"] = """SELECT 'business_rule:admission_date_order' AS "check",
  CASE WHEN bool_and(discharge_date >= admit_date) THEN 'passed' ELSE 'failed' END AS status, count(*) AS rows FROM admissions"""
REQUIRED = {
    "patients": "patient_id age gender age_group", "departments": "department_id department",
    "doctors": "doctor_id department doctor_experience department_id",
    "admissions": "admission_id patient_id doctor_id department_id hospital_id admit_date readmitted_30d readmitted_7d",
    "procedures": "admission_id num_procedures", "medicines": "admission_id medicine_code medicine_count",
    "insurance": "insurance_id insurance_provider",
    "billing": "billing_id admission_id patient_id billed_amount paid_amount claim_gap",
    "claims": "claim_line_id claim_id billing_id claim_status claim_approved",
    "appointments": "appointment_id patient_id doctor_id department_id admit_date appointment_status",
}


def judged(name: str, table: str, broken: str) -> str:
    return f"""SELECT '{name}' AS "check", CASE WHEN {broken} THEN 'failed' ELSE 'passed' END AS status, count(*) AS rows FROM {table}"""


SQL["check_domain_rules"] = " UNION ALL ".join(
    [
        judged("domain:patients.age_range", "patients", "bool_or(age NOT BETWEEN 0 AND 120)"),
        judged("domain:admissions.discharge_after_admit", "admissions", "bool_or(discharge_date < admit_date)"),
        judged("domain:departments.unique_department", "departments", "count(*) > count(DISTINCT department)"),
        judged("domain:insurance.unique_insurance_provider", "insurance", "count(*) > count(DISTINCT insurance_provider)"),
    ]
    + [
        judged(f"domain:{t}.required_columns", t, " OR ".join(f"count({c}) < count(*)" for c in columns.split()))
        for t, columns in REQUIRED.items()
    ]
)
# Feature provenance and insights are fixed rows; the standing governance action adds one to the plan.
SQL["check_provenance"] = """SELECT 'report:feature_provenance' AS "check", 'passed' AS status, CAST(14 AS BIGINT) AS rows
UNION ALL SELECT 'report:business_insights', 'passed', 5
UNION ALL SELECT 'report:accountable_action_plan',
  CASE WHEN count(owner) = count(*) AND count(timeframe) = count(*) THEN 'passed' ELSE 'failed' END, count(*) + 1 FROM actions"""
SQL["damaged_provenance"] = """SELECT 'report:feature_provenance' AS "check", 'failed' AS status, CAST(14 - 1 AS BIGINT) AS rows
UNION ALL SELECT 'report:business_insights', 'failed', 5
UNION ALL SELECT 'report:accountable_action_plan', 'failed', count(*) + 1 FROM actions"""
SQL["check_mart_shape"] = " UNION ALL ".join(
    f"""SELECT 'operational_mart:{name}' AS "check", CASE WHEN count(*) {size} THEN 'passed' ELSE 'failed' END AS status,
    count(*) AS rows FROM {cte}"""
    for name, cte, size in (
        ("command_center_kpis", "snapshot", "= 1"), ("hospital_efficiency_scores", "scores", ">= 1"),
        ("emergency_forecast", "outlook", "= 7"), ("operational_forecast_summary", "plan", "= 1"),
        ("operational_recommendations", "actions", ">= 1"),
    )
)
SQL["check_mart_consistency"] = " UNION ALL ".join(
    [
        judged("consistency:as_of_date", "snapshot", "bool_or(as_of_date <> (SELECT max(admit_date) FROM admissions))"),
        judged(
            "consistency:center_ranges", "snapshot",
            """NOT bool_and(occupancy_pct BETWEEN 0 AND 100 AND doctor_utilization_pct BETWEEN 0 AND 100)
            OR (SELECT NOT bool_and(efficiency_score BETWEEN 0 AND 100) FROM scores WHERE scope_type = 'hospital')""",
        ),
        judged("consistency:efficiency_range", "scores", "NOT bool_and(efficiency_score BETWEEN 0 AND 100)"),
        judged("consistency:hospital_score", "scores WHERE scope_type = 'hospital'", "count(*) <> 1"),
        judged(
            "consistency:forecast_dates", "outlook",
            "min(forecast_date) <= (SELECT max(admit_date) FROM admissions) OR count(DISTINCT forecast_date) < count(*)",
        ),
        judged("consistency:peak_hour_status", "plan", "false"),
        judged(
            "consistency:accountable_recommendations", "actions",
            " OR ".join(f"count({c}) < count(*)" for c in ("owner", "timeframe", "success_measure", "reliability")),
        ),
    ]
)
SQL["damaged_marts"] = " UNION ALL ".join(
    [
        judged("consistency:as_of_date", "(SELECT *, NULL AS unknown FROM snapshot)", "count(unknown) < count(*)"),
        judged("consistency:center_ranges", "snapshot", """NOT bool_and(occupancy_pct BETWEEN 0 AND 100)
            OR (SELECT NOT bool_and(efficiency_score BETWEEN 0 AND 100) FROM scores WHERE scope_type = 'hospital')"""),
        judged("consistency:efficiency_range", "(SELECT CASE WHEN scope_type = 'hospital' THEN efficiency_score ELSE 101 END AS v"
               " FROM scores)", "NOT bool_and(v BETWEEN 0 AND 100)"),
        judged("consistency:hospital_score", "scores WHERE scope_type = 'hospital'", "count(*) <> 1"),
        judged("consistency:forecast_dates", "outlook",
               "min(forecast_date) <= (SELECT max(admit_date) FROM admissions) OR count(DISTINCT forecast_date) < count(*)"),
        judged("consistency:peak_hour_status", "plan WHERE false", "count(*) = 0"),
        judged("consistency:accountable_recommendations", "actions", "count(owner) < count(*)"),
    ]
)
SQL["partial_linkage"] = f"""SELECT CASE WHEN a.admission_id IS NULL THEN 'unlinked' ELSE 'governed_encounter_key' END AS linkage_method,
  {n('bills')}, {total('b.billed_amount', 'billed')}, {total('b.paid_amount', 'paid')} FROM bill_raw_clean b
  LEFT JOIN adm_raw_clean a ON a.admission_id = 'ADM' || substr(b.encounter_id, 4) AND a.ward_type <> 'ICU' GROUP BY 1"""

# --- splits, metrics and forecasting ---
SIDE = h("'42:' || patient_id", 10000)
SQL["group_split"] = f"""SELECT 'hash_bucket(patient_id)' AS split_strategy, count(*) FILTER (WHERE b >= 2000) AS train_rows,
  count(*) FILTER (WHERE b < 2000) AS test_rows, count(DISTINCT patient_id) FILTER (WHERE b >= 2000) AS train_patients,
  count(DISTINCT patient_id) FILTER (WHERE b < 2000) AS test_patients, CAST(0 AS BIGINT) AS patient_overlap
  FROM (SELECT patient_id, {SIDE} AS b FROM model_features)"""
SQL["chronological_split"] = f"""SELECT 'Hospital portfolio' AS series, {day('d', 'date')}, {i('beds', 'occupied_beds')} FROM (SELECT *,
  row_number() OVER (ORDER BY d) AS k, count(*) OVER () AS total FROM census) WHERE k <= floor(total * 0.8e0)"""
SQL["classification_metrics"] = f"""WITH s AS (SELECT readmitted_30d = 1 AS y, risk_score >= 7 AS p, risk_score AS v FROM model_features),
  c AS (SELECT count(*) FILTER (WHERE NOT y AND NOT p) AS tn, count(*) FILTER (WHERE NOT y AND p) AS fp,
    count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE y AND p) AS tp FROM s),
  k AS (SELECT y, (rank() OVER (ORDER BY v)) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS rk FROM s)
  SELECT {r('(tp + tn) / (tn + fp + fn + tp)', 'accuracy')}, {r('coalesce(tp / nullif(tp + fp, 0), 0)', 'precision')},
    {r('coalesce(tp / nullif(tp + fn, 0), 0)', 'recall')}, {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)', 'f1')},
    tn, fp, fn, tp, {r('((SELECT sum(rk) FROM k WHERE y) - (tp + fn) * (tp + fn + 1) / 2) / ((tp + fn) * (tn + fp))', 'roc_auc')} FROM c"""
SQL["occupancy_features"] = f"""SELECT series, {day('date')}, {i('beds', 'occupied_beds')}, {i('isodow(date) - 1', 'dayofweek')},
  {i('month(date)', 'month')}, {i('CASE WHEN isodow(date) > 5 THEN 1 ELSE 0 END', 'is_weekend')}, {i('l1', 'lag_1_beds')},
  {i('l7', 'lag_7_beds')}, {r('week', 'rolling_7_beds')} FROM (SELECT *, lag(beds) OVER o AS l1, lag(beds, 7) OVER o AS l7,
    avg(beds) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS week FROM ward_census
    WINDOW o AS (PARTITION BY series ORDER BY date)) x WHERE l7 IS NOT NULL"""
SQL["moving_average_baseline"] = f"SELECT series, {day('d', 'date')}, {m('beds', 'label')}, {r('week', 'prediction')} FROM baseline"
SQL["regression_metrics"] = f"""SELECT {r('sqrt(avg((beds - week) ** 2))', 'rmse')}, {r('avg(abs(beds - week))', 'mae')},
  {r('avg(abs(beds - week) / greatest(abs(beds), 1))', 'mape')},
  {r('1 - sum((beds - week) ** 2) / sum((beds - mid) ** 2)', 'r2')} FROM baseline, (SELECT avg(beds) AS mid FROM baseline)"""
SQL["horizon_summary"] = f"""SELECT series, {i('h', 'horizon_days')}, {r('avg(week)', 'forecast_occupied_beds')},
  {r('avg(least(week / 500 * 100, 100))', 'forecast_occupancy_pct')} FROM baseline JOIN (SELECT unnest([7, 30, 90]) AS h) ON step <= h
  GROUP BY series, h"""
SQL["forecast_horizon"] = f"""SELECT series, {day('d', 'forecast_date')}, {r('week', 'forecast_occupied_beds')},
  {r('least(week / 500 * 100, 100)', 'forecast_occupancy_pct')}, {r('least(week / 500 * 100, 100)', 'display_occupancy_pct')}
  FROM baseline WHERE step <= 30"""
SQL["forecast_horizon_by_ward"] = f"""SELECT series, {day('date', 'forecast_date')}, {i('beds', 'forecast_occupied_beds')},
  {r('least(beds / 500e0 * 100, 100)', 'display_occupancy_pct')}
  FROM (SELECT *, min(date) OVER (PARTITION BY series) AS opening FROM ward_census) WHERE date < opening + 30"""
SQL["forecast_summary_with_beds"] = SQL["operational_forecast_summary"].replace(
    "CAST(0 AS BIGINT) AS additional_beds",
    i("greatest((SELECT ceil(max(week)) FROM baseline WHERE step <= 7) - (SELECT beds FROM census ORDER BY d DESC LIMIT 1), 0)",
      "additional_beds"))
SCALED = ("los_days", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin", "systolic_bp",
          "previous_admissions", "readmission_history", "disease_severity_score", "lab_abnormality_score",
          "patient_complexity_index")
SQL["sample_rows"] = """SELECT admission_id, patient_id FROM model_features ORDER BY md5('42:' || admission_id), admission_id
  LIMIT 500"""
SQL["standardized_features"] = f"""SELECT admission_id, {', '.join(r(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()', c)
  for c in SCALED)} FROM model_features"""
SQL["check_model_lineage"] = """SELECT 'model:' || t AS "check", 'passed' AS status, CASE WHEN t = 'occupancy' THEN (SELECT count(*) FROM days)
  ELSE (SELECT count(*) FROM model_features) END AS rows
  FROM (SELECT unnest(['readmission', 'waiting_simulation', 'revenue_scenario', 'occupancy']) AS t)
  UNION ALL SELECT 'explanation:' || unnest(['readmission', 'revenue_scenario']), 'passed', NULL"""
SQL["damaged_lineage"] = SQL["check_model_lineage"].replace(
    "'model:' || t AS \"check\", 'passed' AS status",
    "'model:' || t AS \"check\", CASE t WHEN 'waiting_simulation' THEN 'failed' ELSE 'passed' END AS status",
).replace(
    "SELECT 'explanation:' || unnest(['readmission', 'revenue_scenario']), 'passed', NULL",
    "SELECT 'explanation:readmission', 'failed', NULL UNION ALL SELECT 'explanation:revenue_scenario', 'passed', NULL",
)
SQL["damaged_artifact"] = """SELECT 'model:' || t AS "check", CASE t WHEN 'waiting_simulation' THEN 'failed' ELSE 'passed' END AS status,
  CASE WHEN t = 'occupancy' THEN (SELECT count(*) FROM days) ELSE (SELECT count(*) FROM model_features) END AS rows
  FROM (SELECT unnest(['readmission', 'waiting_simulation', 'revenue_scenario', 'occupancy']) AS t)"""
SQL["validate"] = " UNION ALL ".join(
    f"({SQL[k]})" for k in ("check_primary_keys", "check_foreign_keys", "check_admission_dates", "check_domain_rules",
                            "check_mart_shape", "check_mart_consistency", "check_provenance", "check_model_lineage")
)


def statements() -> dict[str, str]:
    return {name: compose(sql) for name, sql in SQL.items()}
