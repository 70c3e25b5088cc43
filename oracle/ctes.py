"""Named CTEs for the DuckDB side of the checks, and their composition into one statement.

The chain follows the pipeline stages (raw, clean, features, warehouse, marts) and is written
independently of the Spark operators: plain windows and joins, no chunking, no pre-aggregation.
"""

from __future__ import annotations

import re

NUMERIC = (
    "los_days", "num_procedures", "charlson_index", "hba1c", "creatinine", "haemoglobin", "systolic_bp",
    "readmitted_30d", "readmitted_7d",
)
FLOORED = ("los_days", "num_procedures", "charlson_index")
LABELS = ("admit_type", "ward_type", "discharge_type", "hospital_id")
DEPARTMENTS = "['Cardiology','Emergency','Orthopedics','Neurology','General Medicine','Pediatrics','Oncology','Surgery']"
MEDICINES = "['MET','AML','ATO','PAN','CEF','INS','PCM','LOS']"


def h(expr: str, modulo: int) -> str:
    """First 32 bits of the MD5 as an integer, reduced."""
    return f"(CAST(concat('0x', substr(md5({expr}), 1, 8)) AS BIGINT) % {modulo})"


def avg(expr: str, alias: str) -> str:
    return f"round(CAST(sum({expr}) AS DOUBLE) / nullif(count({expr}), 0), 6) AS {alias}"


def day(expr: str, alias: str | None = None) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR) AS {alias or expr}"


def total(expr: str, alias: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE) AS {alias}"


def clean_admissions(source: str) -> dict[str, str]:
    """CTEs turning a raw admissions relation into the clean one; names carry the source as prefix."""
    p = source
    typed = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC)
    medians = ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in NUMERIC)
    filled = ", ".join(f"coalesce(t.{c}, m.{c}) AS {c}" for c in NUMERIC)
    labels = ", ".join(f"trim(coalesce(t.{c}, 'Unknown')) AS {c}" for c in LABELS)
    quartiles = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3" for c in NUMERIC)

    def clipped(c: str) -> str:
        spread = f"(q.{c}_3 - q.{c}_1)"
        value = (
            f"CASE WHEN {spread} > 0 THEN least(greatest(f.{c}, q.{c}_1 - 1.5e0 * {spread}), q.{c}_3 + 1.5e0 * {spread})"
            f" ELSE f.{c} END"
        )
        return f"greatest({value}, 0) AS {c}" if c in FLOORED else f"{value} AS {c}"

    return {
        f"{p}_first": f"""SELECT * EXCLUDE (copy_no) FROM (SELECT *, row_number() OVER (PARTITION BY admission_id
            ORDER BY patient_id, admit_date, discharge_date) AS copy_no FROM {p}) WHERE copy_no = 1""",
        f"{p}_typed": f"""SELECT admission_id, patient_id, {', '.join(LABELS)},
            TRY_CAST(CAST(admit_date AS VARCHAR) AS DATE) AS admit_date,
            TRY_CAST(CAST(discharge_date AS VARCHAR) AS DATE) AS discharge_date, {typed} FROM {p}_first""",
        f"{p}_medians": f"SELECT {medians} FROM {p}_typed",
        f"{p}_filled": f"""SELECT t.admission_id, t.patient_id, {labels}, t.admit_date, t.discharge_date, {filled}
            FROM {p}_typed t CROSS JOIN {p}_medians m""",
        f"{p}_quartiles": f"SELECT {quartiles} FROM {p}_filled",
        f"{p}_clean": f"""SELECT f.* REPLACE ({', '.join(clipped(c) for c in NUMERIC)})
            FROM {p}_filled f CROSS JOIN {p}_quartiles q""",
    }


def clean_billing(source: str) -> dict[str, str]:
    p = source
    amounts = ("billed_amount", "paid_amount")
    typed = ", ".join(f"TRY_CAST({c} AS DECIMAL(14,2)) AS {c}" for c in amounts)
    medians = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in amounts)
    filled = ", ".join(f"greatest(coalesce(t.{c}, CAST(m.{c} AS DECIMAL(14,2))), 0) AS {c}" for c in amounts)
    date = "CAST(claim_billing_date AS VARCHAR)"
    return {
        f"{p}_first": f"""SELECT * EXCLUDE (copy_no) FROM (SELECT *, row_number() OVER (PARTITION BY billing_id
            ORDER BY claim_id) AS copy_no FROM {p}) WHERE copy_no = 1""",
        f"{p}_typed": f"""SELECT billing_id, claim_id, patient_id, encounter_id,
            CAST(coalesce(try_strptime({date}, '%d/%m/%Y'), try_strptime({date}, '%Y-%m-%d')) AS DATE) AS claim_billing_date,
            insurance_provider, payment_method, claim_status, {typed} FROM {p}_first""",
        f"{p}_medians": f"SELECT {medians} FROM {p}_typed",
        f"{p}_clean": f"""SELECT *, CAST(billed_amount - paid_amount AS DECIMAL(14,2)) AS claim_gap,
            CASE WHEN claim_status = 'Paid' THEN 1 ELSE 0 END AS claim_approved
            FROM (SELECT t.billing_id, t.claim_id, t.patient_id, t.encounter_id, t.claim_billing_date,
              trim(coalesce(t.insurance_provider, 'Unknown')) AS insurance_provider,
              trim(coalesce(t.payment_method, 'Unknown')) AS payment_method,
              CASE trim(coalesce(t.claim_status, 'Unknown')) WHEN 'Rejected' THEN 'Denied'
                ELSE trim(coalesce(t.claim_status, 'Unknown')) END AS claim_status, {filled}
              FROM {p}_typed t CROSS JOIN {p}_medians m)""",
    }


CTES: dict[str, str] = {
    "adm_raw": """SELECT concat('ADM', CAST(o_orderkey AS VARCHAR)) admission_id,
        concat('PAT', CAST(o_custkey AS VARCHAR)) patient_id, concat('HOS', CAST(c_nationkey AS VARCHAR)) hospital_id,
        CAST(o_orderdate AS DATE) admit_date,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey*7 % 13 AS INT) discharge_date, CAST(o_orderkey*7 % 13 AS INT) los_days,
        CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Emergency'
             WHEN o_orderpriority IN ('3-MEDIUM','4-NOT SPECIFIED') THEN 'OPD' ELSE 'Elective' END admit_type,
        CASE WHEN o_orderkey % 10 = 0 THEN 'ICU' WHEN o_orderkey % 10 = 1 THEN 'HDU'
             WHEN o_orderkey % 10 = 2 THEN 'NICU' ELSE 'General' END ward_type,
        CASE o_orderstatus WHEN 'F' THEN 'Home' WHEN 'O' THEN 'Transfer' ELSE 'Other' END discharge_type,
        CAST(o_orderkey*3 % 5 AS INT) num_procedures, CAST(o_orderkey*11 % 7 AS INT) charlson_index,
        4.5e0 + CAST(o_orderkey*13 % 60 AS DOUBLE)/1e1 hba1c, 0.5e0 + CAST(o_orderkey*17 % 20 AS DOUBLE)/1e1 creatinine,
        8e0 + CAST(o_orderkey*19 % 90 AS DOUBLE)/1e1 haemoglobin, CAST(95 + o_orderkey*23 % 80 AS DOUBLE) systolic_bp,
        CASE WHEN (o_orderkey*29 + o_custkey) % 8 = 0 THEN 1 ELSE 0 END readmitted_30d,
        CASE WHEN (o_orderkey*29 + o_custkey) % 24 = 0 THEN 1 ELSE 0 END readmitted_7d
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "bill_raw": """SELECT concat('BIL', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) billing_id,
        concat('CLM', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) claim_id,
        concat('SRC', CAST(min(o_custkey) AS VARCHAR)) patient_id, concat('ENC', CAST(l_orderkey AS VARCHAR)) encounter_id,
        CAST(min(l_shipdate) AS DATE) claim_billing_date, min(c_mktsegment) insurance_provider,
        CASE WHEN l_linenumber % 3 = 0 THEN 'Cash' WHEN l_linenumber % 3 = 1 THEN 'Card' ELSE 'Transfer' END payment_method,
        CASE WHEN min(l_returnflag)='R' THEN 'Denied'
             WHEN min(l_returnflag)='N' AND min(l_linestatus)='O' THEN 'Pending' ELSE 'Paid' END claim_status,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(14,2)) billed_amount,
        CAST(CASE WHEN min(l_returnflag)='R' OR (min(l_returnflag)='N' AND min(l_linestatus)='O') THEN 0
             ELSE sum(CAST(l_extendedprice AS DECIMAL(14,2)))*0.92 END AS DECIMAL(14,2)) paid_amount
        FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey
        GROUP BY l_orderkey, l_linenumber""",
    "adm_text": """SELECT r.* EXCLUDE (k) REPLACE (
          CAST(admit_date AS VARCHAR) AS admit_date,
          CAST(CASE WHEN k % 211 = 0 THEN admit_date - 3 ELSE discharge_date END AS VARCHAR) AS discharge_date,
          CAST(los_days AS VARCHAR) AS los_days,
          CASE WHEN k % 40 <> 0 THEN ward_type END AS ward_type,
          CAST(num_procedures AS VARCHAR) AS num_procedures, CAST(charlson_index AS VARCHAR) AS charlson_index,
          CASE WHEN k % 50 = 0 THEN 'n/a' ELSE CAST(hba1c AS VARCHAR) END AS hba1c,
          CAST(CASE WHEN k % 97 = 0 THEN creatinine * 50 ELSE creatinine END AS VARCHAR) AS creatinine,
          CAST(haemoglobin AS VARCHAR) AS haemoglobin, CAST(systolic_bp AS VARCHAR) AS systolic_bp,
          CAST(readmitted_30d AS VARCHAR) AS readmitted_30d, CAST(readmitted_7d AS VARCHAR) AS readmitted_7d)
        FROM (SELECT *, CAST(substr(admission_id, 4) AS BIGINT) AS k FROM adm_raw) r
        JOIN (SELECT unnest([1, 2]) AS c) copies ON c = 1 OR k % 100 = 0""",
    "bill_text": """SELECT * EXCLUDE (k, n) REPLACE (
          CASE WHEN k % 33 <> 0 THEN strftime(claim_billing_date, '%d/%m/%Y') END AS claim_billing_date,
          CASE WHEN k % 29 <> 0 THEN insurance_provider END AS insurance_provider,
          CASE WHEN claim_status = 'Denied' AND n = 7 THEN 'Rejected' ELSE claim_status END AS claim_status,
          CAST(billed_amount AS VARCHAR) AS billed_amount, CAST(paid_amount AS VARCHAR) AS paid_amount)
        FROM (SELECT *, CAST(split_part(substr(billing_id, 4), '-', 1) AS BIGINT) AS k,
          CAST(split_part(billing_id, '-', 2) AS INT) AS n FROM bill_raw)""",
    **clean_admissions("adm_raw"),
    **clean_billing("bill_raw"),
    **clean_admissions("adm_text"),
    **clean_billing("bill_text"),
    "bills": """SELECT b.* REPLACE (coalesce(b.claim_billing_date, a.discharge_date) AS claim_billing_date,
          a.patient_id AS patient_id), b.patient_id AS source_patient_id, b.encounter_id AS source_encounter_id,
          a.admission_id, 'governed_encounter_key' AS linkage_method
        FROM bill_raw_clean b JOIN adm_raw_clean a ON a.admission_id = 'ADM' || substr(b.encounter_id, 4)""",
    "shaped": f"""SELECT *, ({h('hospital_id', 8)} + {h('ward_type', 3)}) % 8 AS dept_no FROM adm_raw_clean""",
    "named": f"""SELECT * EXCLUDE (dept_no), {DEPARTMENTS}[dept_no + 1] AS department,
          'DOC' || lpad(CAST(dept_no * 5 + {h('admission_id', 5)} + 1 AS VARCHAR), 3, '0') AS doctor_id,
          18 + {h('patient_id', 72)} AS age, ['Female','Male','Other'][{h('patient_id', 3)} + 1] AS gender,
          {MEDICINES}[{h('admission_id', 8)} + 1] AS medicine_code,
          1 + num_procedures + (CASE WHEN charlson_index > 2 THEN 1 ELSE 0 END) AS medicine_count,
          month(admit_date) AS admit_month, isodow(admit_date) - 1 AS admit_dayofweek,
          CASE WHEN isodow(admit_date) >= 6 THEN 1 ELSE 0 END AS is_weekend_admission,
          row_number() OVER visits - 1 AS previous_admissions,
          coalesce(sum(readmitted_30d) OVER (visits ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS readmission_history,
          count(*) OVER (PARTITION BY department, admit_date) AS department_daily_admissions,
          (CASE WHEN hba1c > 7 THEN 1 ELSE 0 END) + (CASE WHEN creatinine > 1.3e0 THEN 1 ELSE 0 END)
            + (CASE WHEN haemoglobin < 11 THEN 1 ELSE 0 END) + (CASE WHEN systolic_bp > 140 THEN 1 ELSE 0 END)
            AS lab_abnormality_score
        FROM (SELECT *, {DEPARTMENTS}[dept_no + 1] AS department FROM shaped) s
        WINDOW visits AS (PARTITION BY patient_id ORDER BY admit_date, admission_id)""",
    "scored": f"""SELECT n.*, CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '19-35' WHEN age <= 50 THEN '36-50'
            WHEN age <= 65 THEN '51-65' ELSE '66+' END AS age_group,
          CASE WHEN admit_month IN (12, 1, 2) THEN 'Winter' WHEN admit_month IN (3, 4, 5) THEN 'Spring'
            WHEN admit_month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
          department_daily_admissions / max(department_daily_admissions) OVER () AS department_load,
          charlson_index * 2 + lab_abnormality_score AS disease_severity_score,
          {h('doctor_id', 28)} + 2 AS doctor_experience,
          round_even(18 + department_daily_admissions * 1.7e0
            + CASE admit_type WHEN 'Emergency' THEN 18e0 WHEN 'OPD' THEN 28e0 WHEN 'Elective' THEN 8e0 ELSE 12e0 END
            + is_weekend_admission * 9 + charlson_index * 2, 0) AS waiting_time_minutes
        FROM named n""",
    "indexed": """SELECT *, disease_severity_score + previous_admissions + num_procedures AS patient_complexity_index,
          least(1e0, los_days * department_load / 8) AS bed_utilization_score,
          sum(waiting_time_minutes) OVER d / count(*) OVER d AS average_waiting_time
        FROM scored WINDOW d AS (PARTITION BY department)""",
    "bill_sums": """SELECT admission_id, sum(billed_amount) AS billed, sum(paid_amount) AS paid,
          CAST(sum(claim_approved) AS DOUBLE) / count(*) AS approval, count(DISTINCT billing_id) AS bills
        FROM bills GROUP BY admission_id""",
    "priced": """SELECT i.*, patient_complexity_index * 0.30e0 + los_days * 0.25e0 + readmission_history * 0.20e0
            + lab_abnormality_score * 0.15e0 + department_load * 0.10e0 AS risk_score,
          CAST(coalesce(s.billed, CAST(900 + los_days*650 + num_procedures*1200 + charlson_index*300 AS DECIMAL(14,2)))
            AS DECIMAL(14,2)) AS billed_amount,
          s.paid AS paid_sum, coalesce(s.approval, 0.72e0) AS claim_approval_ratio, coalesce(s.bills, 0) AS claim_count
        FROM indexed i LEFT JOIN bill_sums s USING (admission_id)""",
    "model_features": """SELECT * EXCLUDE (paid_sum, bill_rank),
          CAST(coalesce(paid_sum, billed_amount * 0.72) AS DECIMAL(14,2)) AS paid_amount,
          CAST(coalesce(paid_sum, billed_amount * 0.72) AS DECIMAL(14,2)) AS revenue_per_patient,
          CASE WHEN claim_count > 0 THEN 'governed_linked_claim' ELSE 'simulated_cost_formula' END AS revenue_origin,
          CASE WHEN claim_count > 0 THEN 'Insurance' ELSE 'Self Pay' END AS insurance_category,
          ['Low','Medium','High','Very High'][CAST(greatest(1, ceil((bill_rank - 1) * 4
            / greatest((SELECT count(*) FROM priced) - 1, 1))) AS INT)] AS billing_category,
          CAST(round_even(CAST(billed_amount AS DOUBLE) * 0.12e0 / medicine_count * 100, 0) / 100 AS DECIMAL(14,2))
            AS average_medicine_cost,
          num_procedures AS total_procedures, 'simulated_formula' AS waiting_time_origin,
          'deterministic_derived_dimension' AS department_origin, 'deterministic_derived_dimension' AS doctor_origin,
          'deterministic_derived_dimension' AS demographics_origin, 'deterministic_derived_dimension' AS medicine_origin
        FROM (SELECT *, row_number() OVER (ORDER BY billed_amount, patient_id, admit_date, admission_id) AS bill_rank
              FROM priced)""",
    "departments": f"SELECT CAST(unnest(range(1, 9)) AS INT) AS department_id, unnest({DEPARTMENTS}) AS department",
    "patients": "SELECT DISTINCT patient_id, age, gender, age_group FROM model_features",
    "doctors": """SELECT DISTINCT doctor_id, department, doctor_experience, department_id
        FROM model_features JOIN departments USING (department)""",
    "admissions": """SELECT admission_id, patient_id, doctor_id, department_id, hospital_id, admit_date, discharge_date,
          CAST(los_days AS INT) AS los_days, admit_type, ward_type, discharge_type,
          CAST(readmitted_30d AS INT) AS readmitted_30d, CAST(readmitted_7d AS INT) AS readmitted_7d, waiting_time_minutes
        FROM model_features JOIN departments USING (department)""",
    "diagnoses": "SELECT admission_id, charlson_index, disease_severity_score FROM model_features",
    "procedures": "SELECT admission_id, CAST(num_procedures AS INT) AS num_procedures FROM model_features",
    "medicines": """SELECT admission_id, medicine_code, CAST(medicine_count AS INT) AS medicine_count,
          average_medicine_cost FROM model_features""",
    "labs": "SELECT admission_id, hba1c, creatinine, haemoglobin, systolic_bp, lab_abnormality_score FROM model_features",
    "insurance": """SELECT row_number() OVER (ORDER BY insurance_provider) AS insurance_id, insurance_provider
        FROM (SELECT DISTINCT insurance_provider FROM bills)""",
    "billing": """SELECT billing_id, admission_id, patient_id, insurance_id, payment_method, claim_billing_date,
          billed_amount, paid_amount, claim_gap FROM bills JOIN insurance USING (insurance_provider)""",
    "claims": """SELECT 'CLINE-' || billing_id AS claim_line_id, coalesce(claim_id, 'NOCLAIM-' || billing_id) AS claim_id,
          billing_id, insurance_id, claim_status, claim_approved, source_patient_id, source_encounter_id, linkage_method
        FROM bills JOIN insurance USING (insurance_provider)""",
    "appointments": """SELECT 'APT-' || admission_id AS appointment_id, admission_id, patient_id, doctor_id, department_id,
          admit_date, 'Completed' AS appointment_status, '09:00:00' AS scheduled_time FROM admissions""",
    "flat": """SELECT b.billing_id, b.patient_id, b.admission_id AS encounter_id, i.insurance_provider, b.payment_method,
          c.claim_id, b.claim_billing_date, b.billed_amount, b.paid_amount, c.claim_status, b.claim_gap, c.claim_approved
        FROM billing b LEFT JOIN insurance i ON i.insurance_id = b.insurance_id
        LEFT JOIN claims c ON c.billing_id = b.billing_id""",
    "fan": """SELECT a.*, b.paid_amount, c.claim_approved FROM admissions a
        LEFT JOIN billing b ON b.admission_id = a.admission_id LEFT JOIN claims c ON c.billing_id = b.billing_id""",
    "dep_kpis": f"""SELECT department, count(DISTINCT admission_id) AS admissions, count(DISTINCT patient_id) AS patients,
          {avg('readmitted_30d', 'readmission_rate')}, {avg('los_days', 'average_los')},
          {avg('waiting_time_minutes', 'average_wait')}, coalesce(sum(paid_amount), 0) AS revenue
        FROM departments LEFT JOIN fan USING (department_id) GROUP BY department""",
    "doc_kpis": f"""SELECT d.doctor_id, d.department, count(DISTINCT admission_id) AS admissions,
          count(DISTINCT patient_id) AS patients, {avg('waiting_time_minutes', 'avg_wait')},
          {avg('readmitted_30d', 'readmission_rate')}, coalesce(sum(paid_amount), 0) AS revenue
        FROM doctors d LEFT JOIN fan f ON f.doctor_id = d.doctor_id GROUP BY ALL""",
    "month_payer": f"""SELECT strftime(claim_billing_date, '%Y-%m-01') AS month_start, insurance_provider,
          sum(billed_amount) AS billed, sum(paid_amount) AS paid, {avg('claim_approved', 'claim_approval_ratio')}
        FROM flat GROUP BY ALL""",
    "occupancy": """SELECT d.admit_date, d.admissions, (SELECT count(*) FROM admissions a
            WHERE a.admit_date <= d.admit_date AND coalesce(a.discharge_date, d.admit_date) >= d.admit_date) AS beds
        FROM (SELECT admit_date, count(*) AS admissions FROM admissions GROUP BY admit_date) d""",
    "bounds": "SELECT min(admit_date) AS lo, max(admit_date) AS hi FROM model_features",
    "days": "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds",
    "census": """SELECT d, greatest(sum(coalesce(i.n, 0) - coalesce(o.n, 0)) OVER (ORDER BY d), 0) AS beds FROM days
        LEFT JOIN (SELECT admit_date, count(*) AS n FROM model_features GROUP BY 1) i ON i.admit_date = d
        LEFT JOIN (SELECT discharge_date + 1 AS gone, count(*) AS n FROM model_features GROUP BY 1) o ON o.gone = d""",
    "census_pct": "SELECT d, beds, greatest(0e0, least(100e0, beds / 500e0 * 100)) AS pct FROM census",
    "p75": "SELECT quantile_cont(patient_complexity_index, 0.75) AS p75 FROM model_features",
    "today": "SELECT f.* FROM model_features f, bounds WHERE admit_date = hi",
    "snapshot": """SELECT (SELECT hi FROM bounds) AS as_of_date,
          (SELECT count(DISTINCT patient_id) FROM today) AS patients_today,
          (SELECT pct FROM census_pct ORDER BY d DESC LIMIT 1) AS occupancy_pct,
          (SELECT CAST(beds AS BIGINT) FROM census ORDER BY d DESC LIMIT 1) AS occupied_beds,
          coalesce((SELECT avg(waiting_time_minutes) FROM today WHERE admit_type = 'Emergency'),
            (SELECT avg(waiting_time_minutes) FROM model_features, bounds
             WHERE admit_type = 'Emergency' AND admit_date >= hi - 29)) AS emergency_wait_minutes,
          (SELECT count(DISTINCT patient_id) FROM today, p75
           WHERE ward_type = 'ICU' OR patient_complexity_index >= p75) AS critical_patients,
          100 * least(1e0, (SELECT avg(n) FROM (SELECT count(*) AS n FROM today GROUP BY doctor_id))
            / greatest(1e0, (SELECT quantile_cont(n, 0.9) FROM (SELECT count(*) AS n FROM model_features
              GROUP BY admit_date, doctor_id)))) AS doctor_utilization_pct""",
    "rates": """SELECT avg(readmitted_30d) AS readmission, avg(waiting_time_minutes) AS wait,
          (SELECT CAST(sum(paid_amount) AS DOUBLE) / greatest(CAST(sum(billed_amount) AS DOUBLE), 1) FROM billing) AS collection
        FROM model_features""",
    "dep_care": """SELECT department, count(DISTINCT patient_id) AS patients, count(*) AS admissions,
          avg(waiting_time_minutes) AS wait, avg(readmitted_30d) AS readmission, avg(bed_utilization_score) AS pressure
        FROM model_features GROUP BY department""",
    "scores": """SELECT 'hospital' AS scope_type, 'Hospital portfolio' AS scope_name,
          o * 0.4e0 + c * 0.3e0 + b * 0.2e0 + f * 0.1e0 AS efficiency_score, o AS patient_outcome_score, c AS collection_score,
          b AS capacity_balance_score, f AS patient_flow_score, 'mixed_observed_derived_simulated_assumed' AS provenance
        FROM (SELECT greatest(0e0, least(100e0, (0.25e0 - readmission) / (0.25e0 - 0.10e0) * 100)) AS o,
            greatest(0e0, least(100e0, collection / 0.7e0 * 100)) AS c,
            greatest(0e0, least(100e0, 100 - abs(occupancy_pct - 80) * 2)) AS b,
            greatest(0e0, least(100e0, 100 - wait / 90 * 100)) AS f FROM rates, snapshot)
        UNION ALL
        SELECT 'department', department, o * 0.5e0 + f * 0.25e0 + b * 0.25e0, o, NULL, b, f, 'derived_portfolio_dimension'
        FROM (SELECT department, (1 - readmission) * 100 AS o, greatest(0e0, least(100e0, 100 - wait / 90 * 100)) AS f,
            greatest(0e0, least(100e0, pressure / greatest(max(pressure) OVER (), 0.01e0) * 100)) AS b FROM dep_care)""",
    "ward_census": """SELECT w AS series, d AS date, greatest(sum(coalesce(i.n, 0) - coalesce(o.n, 0))
          OVER (PARTITION BY w ORDER BY d), 0) AS beds FROM days CROSS JOIN (SELECT DISTINCT ward_type AS w FROM model_features)
        LEFT JOIN (SELECT ward_type, admit_date, count(*) AS n FROM model_features GROUP BY ALL) i
          ON i.admit_date = d AND i.ward_type = w
        LEFT JOIN (SELECT ward_type, discharge_date + 1 AS gone, count(*) AS n FROM model_features GROUP BY ALL) o
          ON o.gone = d AND o.ward_type = w""",
    "lagged": """SELECT * FROM (SELECT d, CAST(beds AS DOUBLE) AS beds, avg(beds) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING
          AND 1 PRECEDING) AS week, row_number() OVER (ORDER BY d) AS k FROM census) WHERE k > 7""",
    "baseline": """SELECT 'Hospital portfolio' AS series, d, beds, week, row_number() OVER (ORDER BY d) AS step FROM lagged
        WHERE k > 7 + floor((SELECT count(*) FROM lagged) * 0.8e0)""",
    "urgent_daily": """SELECT admit_date, count(*) AS n FROM model_features WHERE admit_type = 'Emergency' GROUP BY 1""",
    "recent": """SELECT d, isodow(d) AS w, coalesce(n, 0) AS n FROM days LEFT JOIN urgent_daily ON admit_date = d
        ORDER BY d DESC LIMIT 56""",
    "outlook": """SELECT forecast_date, coalesce(m, (SELECT avg(n) FROM recent)) AS patients
        FROM (SELECT hi + CAST(unnest(range(1, 8)) AS INT) AS forecast_date FROM bounds)
        LEFT JOIN (SELECT w, avg(n) AS m FROM recent GROUP BY w) ON w = isodow(forecast_date)""",
    "plan": """SELECT min(forecast_date) AS starts, max(forecast_date) AS ends, sum(patients) AS next_week,
          (SELECT coalesce(sum(n), 0) FROM (SELECT n FROM urgent_daily ORDER BY admit_date DESC LIMIT 7)) AS last_week,
          arg_max(forecast_date, (patients, -epoch(forecast_date))) AS peak, max(patients) AS peak_patients FROM outlook""",
    "actions": """SELECT 'P1' AS priority, 'Readmission control' AS title,
          printf('%.1f%%', readmission * 100) || ' hospital-wide readmission' AS signal,
          'Prioritize ICU discharge review and post-discharge follow-up.' AS action, 'Clinical Quality Lead' AS owner,
          '30 days' AS timeframe, 'Root-cause review completed and approved ward target set' AS success_measure,
          'observed' AS reliability FROM rates WHERE readmission > 0.1e0
        UNION ALL SELECT 'P1', 'Collection recovery', printf('%.1f%%', collection * 100) || ' of billed value collected',
          'Review payer-specific billed-to-paid gaps and aged claims.', 'Revenue Cycle Manager', '30 days',
          'Collection rate monitored against illustrative 70% threshold', 'observed' FROM rates WHERE collection < 0.7e0
        UNION ALL SELECT 'P2', 'Queue-data readiness',
          CAST(CAST(round_even(emergency_wait_minutes, 0) AS BIGINT) AS VARCHAR) || ' minute simulated emergency wait',
          'Capture arrival, triage, and service-start timestamps before staffing optimization.', 'Operations Data Owner',
          '60 days', 'Observed queue timestamps pass completeness checks', 'simulated_workflow_measure' FROM snapshot""",
}


def compose(statement: str) -> str:
    """Prefix a statement with the CTEs it reaches, dependencies first."""
    ordered: list[str] = []

    def visit(sql: str, stack: tuple[str, ...]) -> None:
        words = set(re.findall(r"[a-z_][a-z_0-9]*", re.sub(r"'[^']*'", "''", sql)))
        for name in CTES:
            if name in words and name not in stack and name not in ordered:
                visit(CTES[name], (*stack, name))
                ordered.append(name)

    visit(statement, ())
    if not ordered:
        return statement
    prefix = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    if statement.startswith("WITH "):
        return prefix + ",\n" + statement.removeprefix("WITH ")
    return prefix + "\n" + statement
