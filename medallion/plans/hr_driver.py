"""The HR application run on data derived from the driver's tables, with DuckDB oracles.

``customer`` becomes the employee roster of two entities (FR: nation keys below 13, BE: the rest) and
``orders`` the absence events.  Deliveries, all derived from whole tables by fixed rules of this test:

* seed (2024-01-01 08:00): every customer; AUTOMOBILE customers also have an earlier draft row (06:00);
* increment (2024-01-08 08:00): BUILDING customers moved to the next department;
* late delivery (2024-01-05 08:00, landed after the first run): FURNITURE customers switched to CDD;
* data-quality cases: balance above 9900 → no birth date (dropped); nation 24 MACHINERY → unknown department
  D999 (warned, kept); nation 23 HOUSEHOLD → contract Freelance (warned); orders under 2000 → 0 days
  (dropped); pending orders → no absence type (warned); 5-LOW orders → lower-case, padded employee id.

Then ``hr360.run_update`` runs twice (the second run picks up only the late file) and the registered queries
read its tables.  The oracles recompute everything from ``customer`` / ``orders`` in SQL.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators import cdc
from medallion.operators.classify import HR_REASON_PATTERNS
from medallion.plans import hr360
from medallion.plans.driver import register, tbl
from medallion.session import work_dir
from medallion.sources.tables import PipelineConfig

AS_OF = "2026-01-01"
T_SEED, T_DRAFT = "2024-01-01T08:00:00.000000", "2024-01-01T06:00:00.000000"
T_INCREMENT, T_LATE = "2024-01-08T08:00:00.000000", "2024-01-05T08:00:00.000000"
# The absence types of the reference's event generator.
ABSENCE_TYPES = ["Congés payés", "Maladie", "RTT", "Formation", "Congé maternité", "Congé sans solde"]
COMMENTS = {"1-URGENT": "Rendez-vous médecin", "2-HIGH": "Formation sécurité", "3-MEDIUM": "Mariage de ma soeur"}

_RUNS: dict = {}
_LOCK = threading.Lock()


def _roster(spark: SparkSession, sf: str) -> DataFrame:
    c = tbl(spark, sf, "customer")
    ent = F.when(F.col("c_nationkey") < 13, "FR").otherwise("BE")
    birth = F.when(F.col("c_acctbal") > 9900, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(F.col("c_custkey") * 37, F.lit(14000)).cast("int")))
    hire = F.when(birth.isNull(), F.lit("2010-01-01").cast("date")).otherwise(
        F.date_add(birth, (F.lit(7000) + F.pmod(F.col("c_custkey") * 13, F.lit(5000))).cast("int")))
    contracts = F.array(*[F.lit(x) for x in hr360.CONTRACT_TYPES])
    return c.select(
        "c_custkey", "c_nationkey", "c_mktsegment", ent.alias("source_entity"),
        F.concat(F.lit("EMP"), ent, F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("employee_id"),
        F.lower("c_name").alias("first_name"), F.lower("c_mktsegment").alias("last_name"),
        F.when(F.pmod("c_custkey", F.lit(2)) == 0, "F").otherwise("M").alias("gender"),
        F.date_format(birth, "yyyy-MM-dd").alias("birth_date"), F.date_format(hire, "yyyy-MM-dd").alias("hire_date"),
        F.when((F.col("c_nationkey") == 24) & (F.col("c_mktsegment") == "MACHINERY"), "D999").otherwise(
            F.concat(F.lit("D"), F.lpad((F.pmod("c_nationkey", F.lit(12)) + 1).cast("string"), 3, "0")))
        .alias("department_id"),
        F.col("c_mktsegment").alias("job_title"),
        F.when((F.col("c_nationkey") == 23) & (F.col("c_mktsegment") == "HOUSEHOLD"), "Freelance").otherwise(
            F.element_at(contracts, (F.pmod("c_custkey", F.lit(5)) + 1).cast("int"))).alias("contract_type"),
        F.concat(F.lit("Site "), F.col("c_nationkey").cast("string")).alias("work_location"),
        F.lit(None).cast("string").alias("manager_id"),
        F.concat(F.lit("EMP"), F.col("c_custkey").cast("string"), F.lit("@Example.com")).alias("email"),
        F.when(F.pmod("c_custkey", F.lit(3)) == 0, 0.8).otherwise(1.0).alias("fte"),
        F.when(F.col("c_acctbal") < 0, "Inactive").otherwise("Active").alias("status"))


_EMP_FIELDS = ["employee_id", "first_name", "last_name", "gender", "birth_date", "hire_date", "department_id",
               "job_title", "contract_type", "work_location", "manager_id", "email", "fte", "status"]


def _delivery(df: DataFrame, ts: str, updated: str | None = None) -> DataFrame:
    return df.select("source_entity", *_EMP_FIELDS, F.lit(ts[:10]).alias("extract_date"),
                     F.lit(ts).alias("extract_ts"), F.lit(updated or ts).alias("updated_at"))


def _write_lines(df: DataFrame, path: str, one_file: bool = True) -> None:
    """JSON lines: ``path/source_entity=<E>/part-*.txt``, one file per entity and delivery, or as many as the size asks
    for (adaptive execution splits an entity's rows, so that no task sorts and writes them all)."""
    payload = F.to_json(F.struct(*[c for c in df.columns if c != "source_entity"]), {"ignoreNullFields": "false"})
    lines = df.select("source_entity", payload.alias("v"))
    dealt = lines.repartition("source_entity") if one_file else lines.hint("rebalance", "source_entity")
    dealt.write.mode("append").partitionBy("source_entity").text(path)


def land_employees(spark: SparkSession, sf: str, landing: str, late: bool) -> None:
    r = _roster(spark, sf)
    if late:
        _write_lines(_delivery(r.where("c_mktsegment = 'FURNITURE'").withColumn("contract_type", F.lit("CDD")),
                               T_LATE), landing)
        return
    seed = _delivery(r, T_SEED).unionByName(
        _delivery(r.where("c_mktsegment = 'AUTOMOBILE'").withColumn("job_title", F.lit("Draft")), T_SEED, T_DRAFT))
    _write_lines(seed, landing)
    moved = r.where("c_mktsegment = 'BUILDING'").withColumn(
        "department_id", F.concat(F.lit("D"), F.lpad((F.pmod(F.col("c_nationkey") + 1, F.lit(12)) + 1)
                                                     .cast("string"), 3, "0")))
    _write_lines(_delivery(moved, T_INCREMENT), landing)


def land_absences(spark: SparkSession, sf: str, landing: str) -> None:
    o = tbl(spark, sf, "orders")
    r = _roster(spark, sf).select("c_custkey", "source_entity", "employee_id")
    j = o.join(r, o["o_custkey"] == r["c_custkey"])
    types = F.array(*[F.lit(x) for x in ABSENCE_TYPES])
    start = F.date_add(F.lit("2025-07-01").cast("date"), F.pmod("o_orderkey", F.lit(365)).cast("int"))
    days = F.when(F.col("o_totalprice") < 2000, 0).otherwise(F.pmod("o_orderkey", F.lit(10)) + 1)
    comment = F.lit(None).cast("string")
    for prio, text in COMMENTS.items():
        comment = F.when(F.col("o_orderpriority") == prio, F.lit(text)).otherwise(comment)
    out = j.select(
        "source_entity",
        F.concat(F.lit("ABS-"), F.col("source_entity"), F.lit("-1-"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"))
        .alias("absence_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lower("employee_id"), F.lit(" ")))
        .otherwise(F.col("employee_id")).alias("employee_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.element_at(types, (F.pmod("o_orderkey", F.lit(6)) + 1).cast("int"))).alias("absence_type"),
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.date_add(start, (F.greatest(days, F.lit(1)) - 1).cast("int")), "yyyy-MM-dd").alias("end_date"),
        days.cast("int").alias("days"),
        F.concat(F.date_format(start, "yyyy-MM-dd"), F.lit("T08:00:00")).alias("event_timestamp"),
        comment.alias("comment"))
    _write_lines(out, landing, one_file=False)  # nothing reads the file that an absence came in


def run_hr(spark: SparkSession, sf: str):
    """Land, run, land the late delivery, run again (once per session and data folder)."""
    key = (spark.sparkContext.applicationId, sf, "hr")
    with _LOCK:
        if key in _RUNS:
            return _RUNS[key]
        root = work_dir(spark, "hr-run")
        emp_land, abs_land = f"{root}/landing/employees", f"{root}/landing/absences"
        land_employees(spark, sf, emp_land, late=False)
        land_absences(spark, sf, abs_land)
        cfg = PipelineConfig(root=f"{root}/lake", as_of=AS_OF,
                             employees={e: f"{emp_land}/source_entity={e}" for e in hr360.ENTITIES},
                             absences={e: f"{abs_land}/source_entity={e}" for e in hr360.ENTITIES})
        deps = spark.createDataFrame(hr360.DEPARTMENTS, hr360.DEPARTMENT_SCHEMA)

        def run():
            from medallion.streaming.flows import Pipeline
            p = Pipeline(spark, cfg.root)
            p.catalog.table("departments").overwrite(deps)
            emp, abs_ = hr360.datasets(p.catalog.read("departments"), cfg.as_of, buckets=16)
            flows_e = [type(f)(f.entity, f.path, "*.txt") for f in cfg.employee_flows()]
            flows_a = [type(f)(f.entity, f.path, "*.txt") for f in cfg.absence_flows()]
            p.run([(emp, flows_e), (abs_, flows_a)], hr360.views(cfg.as_of))
            return p

        run()
        land_employees(spark, sf, emp_land, late=True)
        p = run()
        _RUNS[key] = p
        return p


# ---------------------------------------------------------------------------------------------- oracle SQL
def _dept_values() -> str:
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in hr360.DEPARTMENTS)
    return (f"departments AS (SELECT * FROM (VALUES {rows}) AS d(department_id, department_name, business_unit, "
            f"region, country, cost_center))")


def _ts_sql(ts: str) -> str:
    return f"TIMESTAMP '{ts.replace('T', ' ')}'"


_CONTRACTS = "[" + ", ".join(f"'{c}'" for c in hr360.CONTRACT_TYPES) + "]"
_TYPES = "[" + ", ".join(f"'{t}'" for t in ABSENCE_TYPES) + "]"
_COMMENT_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COMMENTS.items()) + " END"

BASE_SQL = f"""
{_dept_values()},
roster AS (
  SELECT c_custkey, c_nationkey, c_mktsegment, ent AS source_entity,
         'EMP' || ent || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS employee_id,
         CASE WHEN c_nationkey = 24 AND c_mktsegment = 'MACHINERY' THEN 'D999'
              ELSE 'D' || lpad(CAST((c_nationkey % 12) + 1 AS VARCHAR), 3, '0') END AS department_id,
         c_mktsegment AS job_title,
         CASE WHEN c_nationkey = 23 AND c_mktsegment = 'HOUSEHOLD' THEN 'Freelance'
              ELSE {_CONTRACTS}[(c_custkey % 5) + 1] END AS contract_type,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS status,
         birth_date,
         CASE WHEN birth_date IS NULL THEN DATE '2010-01-01'
              ELSE birth_date + CAST(7000 + (c_custkey * 13) % 5000 AS INTEGER) END AS hire_date
  FROM (SELECT *, CASE WHEN c_nationkey < 13 THEN 'FR' ELSE 'BE' END AS ent,
               CASE WHEN c_acctbal > 9900 THEN NULL
                    ELSE DATE '1960-01-01' + CAST((c_custkey * 37) % 14000 AS INTEGER) END AS birth_date
        FROM customer)),
emp_rows AS (
  SELECT source_entity, employee_id, department_id, job_title, contract_type, gender, status, birth_date, hire_date,
         {_ts_sql(T_SEED)} AS extract_ts, {_ts_sql(T_SEED)} AS updated_at FROM roster
  UNION ALL
  SELECT source_entity, employee_id, department_id, 'Draft', contract_type, gender, status, birth_date, hire_date,
         {_ts_sql(T_SEED)}, {_ts_sql(T_DRAFT)} FROM roster WHERE c_mktsegment = 'AUTOMOBILE'
  UNION ALL
  SELECT source_entity, employee_id, 'D' || lpad(CAST(((c_nationkey + 1) % 12) + 1 AS VARCHAR), 3, '0'), job_title,
         contract_type, gender, status, birth_date, hire_date, {_ts_sql(T_INCREMENT)}, {_ts_sql(T_INCREMENT)}
  FROM roster WHERE c_mktsegment = 'BUILDING'
  UNION ALL
  SELECT source_entity, employee_id, department_id, job_title, 'CDD', gender, status, birth_date, hire_date,
         {_ts_sql(T_LATE)}, {_ts_sql(T_LATE)} FROM roster WHERE c_mktsegment = 'FURNITURE'),
emp_silver AS (
  SELECT r.*, d.department_name, d.business_unit, d.region,
         CAST(floor(datediff('day', r.birth_date, DATE '{AS_OF}') / 365.25) AS INTEGER) AS age,
         round(datediff('day', r.hire_date, DATE '{AS_OF}') / 365.25, 1) AS seniority_years
  FROM emp_rows r LEFT JOIN departments d ON r.department_id = d.department_id),
emp_flags AS (
  SELECT *,
         NOT coalesce(birth_date IS NOT NULL AND birth_date > DATE '1940-01-01', true) AS v_birth,
         NOT coalesce(hire_date IS NOT NULL AND hire_date >= birth_date, true) AS v_hire,
         NOT coalesce(age BETWEEN 16 AND 75, true) AS v_age,
         NOT coalesce(department_name IS NOT NULL, true) AS v_dept,
         NOT coalesce(contract_type IN ('CDI','CDD','Alternance','Stage','Intérim'), true) AS v_contract
  FROM emp_silver),
emp_kept AS (SELECT * FROM emp_flags WHERE NOT (v_birth OR v_hire OR v_age)),
emp_current AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY extract_ts DESC, updated_at DESC) AS rn
    FROM emp_kept) WHERE rn = 1),
abs_rows AS (
  SELECT r.source_entity,
         'ABS-' || r.source_entity || '-1-' || lpad(CAST(o.o_orderkey AS VARCHAR), 7, '0') AS absence_id,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN lower(r.employee_id) || ' ' ELSE r.employee_id END AS employee_id,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE {_TYPES}[(o.o_orderkey % 6) + 1] END AS absence_type,
         DATE '2025-07-01' + CAST(o.o_orderkey % 365 AS INTEGER) AS start_date,
         CASE WHEN o.o_totalprice < 2000 THEN 0 ELSE CAST(o.o_orderkey % 10 + 1 AS INTEGER) END AS days,
         {_COMMENT_SQL} AS comment
  FROM orders o JOIN roster r ON o.o_custkey = r.c_custkey),
abs_silver AS (
  SELECT *, start_date + (greatest(days, 1) - 1) AS end_date,
         CAST(date_trunc('month', start_date) AS TIMESTAMP) AS absence_month,
         NOT coalesce(days > 0 AND days <= 365, true) AS v_days,
         NOT coalesce(absence_type IS NOT NULL, true) AS v_type
  FROM abs_rows),
abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days)
"""


def _sql(body: str) -> str:
    return "WITH " + BASE_SQL.strip() + "\n" + body


@register("hr_headcount", _sql("""
SELECT department_id, department_name, business_unit, region, COUNT(*) AS headcount,
       ROUND(AVG(age), 1) AS avg_age, ROUND(AVG(CAST(seniority_years AS DOUBLE)), 1) AS avg_seniority_years,
       CAST(SUM(CASE WHEN contract_type = 'CDI' THEN 1 ELSE 0 END) AS BIGINT) AS cdi_count,
       CAST(SUM(CASE WHEN gender = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS female_count,
       ROUND(SUM(CASE WHEN gender = 'F' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 1) AS female_pct
FROM emp_current WHERE status = 'Active'
GROUP BY department_id, department_name, business_unit, region
"""))
def q_hr_headcount(spark, sf):
    """The headcount KPI table of the HR application (13 groups: D999 rows are warned, not dropped)."""
    h = run_hr(spark, sf).catalog.read("gold_headcount_by_department")
    return h.select(*[c for c in h.columns if c not in ("cdi_count", "female_count")],
                    F.col("cdi_count").cast("long").alias("cdi_count"),
                    F.col("female_count").cast("long").alias("female_count"))


@register("hr_employee_360", _sql("""
SELECT e.employee_id, e.department_id, e.status,
       CAST(coalesce(a.days, 0) AS BIGINT) AS absence_days_ytd, CAST(coalesce(a.n, 0) AS BIGINT) AS absence_events_ytd
FROM emp_current e
LEFT JOIN (SELECT employee_id, SUM(days) AS days, COUNT(*) AS n FROM abs_kept
           WHERE year(start_date) = year(DATE '2026-01-01') GROUP BY employee_id) a ON e.employee_id = a.employee_id
WHERE e.status = 'Active'
"""))
def q_hr_employee_360(spark, sf):
    """Active employees with year-to-date absence KPIs (exact id join, zero when none)."""
    v = run_hr(spark, sf).catalog.read("gold_employee_360")
    return v.select("employee_id", "department_id", "status", "absence_days_ytd", "absence_events_ytd")


@register("hr_absenteeism", _sql("""
SELECT e.department_id, e.department_name, e.business_unit, a.absence_month, a.absence_type,
       COUNT(DISTINCT a.employee_id) AS employees_absent, COUNT(a.absence_id) AS absence_events,
       CAST(SUM(a.days) AS BIGINT) AS total_absence_days,
       ROUND(SUM(a.days) / COUNT(a.absence_id), 1) AS avg_days_per_absence
FROM abs_kept a JOIN emp_current e ON upper(trim(a.employee_id)) = upper(trim(e.employee_id))
GROUP BY ALL
"""))
def q_hr_absenteeism(spark, sf):
    """Absences × employees (case/space-insensitive ids) by department, month and type."""
    return run_hr(spark, sf).catalog.read("gold_absenteeism_by_department").withColumn(
        "absence_month", F.col("absence_month").cast("timestamp_ntz"))


def _label_sql(col: str, patterns: dict, default: str) -> str:
    score = {lab: " + ".join(f"(CASE WHEN regexp_matches({col}, '{p}', 'i') THEN 1 ELSE 0 END)" for p in pats)
             for lab, pats in patterns.items()}
    best = "greatest(" + ", ".join(f"({s})" for s in score.values()) + ")"
    whens = " ".join(f"WHEN ({s}) = {best} AND ({s}) > 0 THEN '{lab}'" for lab, s in score.items())
    return f"CASE {whens} ELSE '{default}' END"


@register("hr_reasons", _sql(f"""
SELECT e.department_name, e.business_unit,
       {_label_sql('a.comment', HR_REASON_PATTERNS, list(HR_REASON_PATTERNS)[-1])} AS reason_category,
       COUNT(a.absence_id) AS absence_events, CAST(SUM(a.days) AS BIGINT) AS total_absence_days
FROM abs_kept a JOIN emp_current e ON upper(trim(a.employee_id)) = upper(trim(e.employee_id))
WHERE a.comment IS NOT NULL
GROUP BY ALL
"""))
def q_hr_reasons(spark, sf):
    """Distinct comments classified once, joined back, by department and reason."""
    return run_hr(spark, sf).catalog.read("gold_absence_reasons_by_department")


@register("hr_history", _sql("""
, w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS rn,
               LAG(department_id) OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS p_dep,
               LAG(contract_type) OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS p_con,
               LAG(job_title) OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS p_job
        FROM emp_kept),
c AS (SELECT *, SUM(CASE WHEN rn = 1 OR department_id IS DISTINCT FROM p_dep OR contract_type IS DISTINCT FROM p_con
                          OR job_title IS DISTINCT FROM p_job THEN 1 ELSE 0 END)
                  OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM w),
i AS (SELECT employee_id, isl,
             first(extract_ts ORDER BY extract_ts, updated_at) AS start_extract_ts,
             first(updated_at ORDER BY extract_ts, updated_at) AS start_updated_at,
             last(department_id ORDER BY extract_ts, updated_at) AS department_id,
             last(contract_type ORDER BY extract_ts, updated_at) AS contract_type,
             last(job_title ORDER BY extract_ts, updated_at) AS job_title,
             last(status ORDER BY extract_ts, updated_at) AS status
      FROM c GROUP BY employee_id, isl)
SELECT employee_id, department_id, contract_type, job_title, status, start_extract_ts, start_updated_at,
       LEAD(start_extract_ts) OVER (PARTITION BY employee_id ORDER BY isl) AS end_extract_ts,
       LEAD(start_updated_at) OVER (PARTITION BY employee_id ORDER BY isl) AS end_updated_at
FROM i
""").replace("abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days)\n\n,", "abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days),"))
def q_hr_history(spark, sf):
    """SCD 2 on department / contract / job; drafts give short versions, the late file splits history."""
    h = run_hr(spark, sf).catalog.read("gold_employees_history")
    return h.select("employee_id", "department_id", "contract_type", "job_title", "status",
                    F.col(f"{cdc.START_AT}.extract_ts").cast("timestamp_ntz").alias("start_extract_ts"),
                    F.col(f"{cdc.START_AT}.updated_at").cast("timestamp_ntz").alias("start_updated_at"),
                    F.col(f"{cdc.END_AT}.extract_ts").cast("timestamp_ntz").alias("end_extract_ts"),
                    F.col(f"{cdc.END_AT}.updated_at").cast("timestamp_ntz").alias("end_updated_at"))


@register("hr_last_extract", _sql("""
, last_ts AS (SELECT source_entity, max(extract_ts) AS ts FROM emp_kept GROUP BY source_entity),
f AS (SELECT k.* FROM emp_kept k JOIN last_ts l ON k.source_entity = l.source_entity AND k.extract_ts = l.ts)
SELECT source_entity, employee_id, department_id, job_title,
       COUNT(*) OVER (PARTITION BY source_entity, employee_id) AS versions_in_file
FROM f QUALIFY ROW_NUMBER() OVER (PARTITION BY source_entity, employee_id ORDER BY updated_at DESC) = 1
""").replace("abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days)\n\n,", "abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days),"))
def q_hr_last_extract(spark, sf):
    """The newest delivered file per entity (the late file is older, so not the last one)."""
    v = run_hr(spark, sf).catalog.read("silver_employees_last_extract")
    return v.select("source_entity", "employee_id", "department_id", "job_title", "versions_in_file")


@register("hr_quality", _sql("""
, e AS (SELECT 'silver_employees' AS dataset, COUNT(*) AS n, COUNT(*) FILTER (WHERE employee_id IS NULL) AS f0,
               COUNT(*) FILTER (WHERE v_birth) AS f1, COUNT(*) FILTER (WHERE v_hire) AS f2,
               COUNT(*) FILTER (WHERE v_age) AS f3, COUNT(*) FILTER (WHERE v_dept) AS f4,
               COUNT(*) FILTER (WHERE v_contract) AS f5, 0 AS f6 FROM emp_flags),
a AS (SELECT 'silver_absences' AS dataset, COUNT(*) AS n, COUNT(*) FILTER (WHERE absence_id IS NULL) AS f0,
             COUNT(*) FILTER (WHERE employee_id IS NULL) AS f1,
             COUNT(*) FILTER (WHERE NOT coalesce(start_date IS NOT NULL AND end_date >= start_date, true)) AS f2,
             COUNT(*) FILTER (WHERE v_days) AS f3, COUNT(*) FILTER (WHERE v_type) AS f4 FROM abs_silver),
rules(dataset, rule, action, i) AS (VALUES
  ('silver_employees', 'valid_employee_id', 'fail', 0), ('silver_employees', 'valid_birth_date', 'drop', 1),
  ('silver_employees', 'valid_hire_date', 'drop', 2), ('silver_employees', 'plausible_age', 'drop', 3),
  ('silver_employees', 'known_department', 'warn', 4), ('silver_employees', 'valid_contract', 'warn', 5),
  ('silver_employees', 'valid_entity', 'drop', 6),
  ('silver_absences', 'valid_absence_id', 'fail', 0), ('silver_absences', 'valid_employee', 'drop', 1),
  ('silver_absences', 'valid_dates', 'drop', 2), ('silver_absences', 'positive_days', 'drop', 3),
  ('silver_absences', 'known_type', 'warn', 4))
SELECT r.dataset, r.rule, r.action, CAST(x.failed AS BIGINT) AS failed, CAST(x.n - x.failed AS BIGINT) AS passed
FROM rules r JOIN (
  SELECT dataset, n, unnest([f0, f1, f2, f3, f4, f5, f6]) AS failed, unnest(range(7)) AS i FROM e
  UNION ALL
  SELECT dataset, n, unnest([f0, f1, f2, f3, f4]) AS failed, unnest(range(5)) AS i FROM a) x
ON r.dataset = x.dataset AND r.i = x.i
""").replace("abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days)\n\n,", "abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days),"))
def q_hr_quality(spark, sf):
    """Q5/Q7: failed / passed per rule of the 12 application rules, over every delivered row."""
    from medallion.streaming.flows import quality_summary
    p = run_hr(spark, sf)
    return quality_summary(p, "silver_employees").unionByName(quality_summary(p, "silver_absences"))


# ------------------------------------------------------------------------------------- validation queries
_AGE_CASE = ("CASE WHEN age < 20 THEN '<20' WHEN age < 35 THEN '20-34' WHEN age < 45 THEN '35-44' "
             "WHEN age < 55 THEN '45-54' ELSE '55+' END")
HISTORY_BODY = """
, w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS rn,
               LAG(department_id) OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS p_dep,
               LAG(contract_type) OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS p_con,
               LAG(job_title) OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at) AS p_job
        FROM emp_kept),
c AS (SELECT *, SUM(CASE WHEN rn = 1 OR department_id IS DISTINCT FROM p_dep OR contract_type IS DISTINCT FROM p_con
                          OR job_title IS DISTINCT FROM p_job THEN 1 ELSE 0 END)
                  OVER (PARTITION BY employee_id ORDER BY extract_ts, updated_at
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM w),
i AS (SELECT employee_id, isl,
             first(extract_ts ORDER BY extract_ts, updated_at) AS start_extract_ts,
             first(updated_at ORDER BY extract_ts, updated_at) AS start_updated_at,
             last(department_id ORDER BY extract_ts, updated_at) AS department_id,
             last(contract_type ORDER BY extract_ts, updated_at) AS contract_type,
             last(job_title ORDER BY extract_ts, updated_at) AS job_title,
             last(status ORDER BY extract_ts, updated_at) AS status
      FROM c GROUP BY employee_id, isl)
SELECT employee_id, department_id, contract_type, job_title, status, start_extract_ts, start_updated_at,
       LEAD(start_extract_ts) OVER (PARTITION BY employee_id ORDER BY isl) AS end_extract_ts,
       LEAD(start_updated_at) OVER (PARTITION BY employee_id ORDER BY isl) AS end_updated_at
FROM i
"""
_FIX = ("abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days)\n\n,", "abs_kept AS (SELECT * FROM abs_silver WHERE NOT v_days),")


@register("hr_rows_per_entity", _sql("""
SELECT source_entity, COUNT(*) AS rows, COUNT(DISTINCT extract_ts) AS files, COUNT(DISTINCT employee_id) AS employees
FROM emp_rows GROUP BY source_entity
"""))
def q_hr_rows_per_entity(spark, sf):
    """Rows, delivered files and distinct employees per entity (bronze)."""
    return hr360.rows_files_keys(run_hr(spark, sf).catalog.read("bronze_employees"))


@register("hr_duplicates_histogram", _sql("""
SELECT versions, COUNT(*) AS employees FROM (
  SELECT source_entity, extract_ts, employee_id, COUNT(*) AS versions FROM emp_kept GROUP BY ALL)
GROUP BY versions
"""))
def q_hr_duplicates_histogram(spark, sf):
    """How many employees appear n times inside one delivered file (silver)."""
    return hr360.duplicates_histogram(run_hr(spark, sf).catalog.read("silver_employees"))


@register("hr_consistency", "SELECT CAST(0 AS BIGINT) AS differences")
def q_hr_consistency(spark, sf):
    """The streaming SCD 1 table equals keep-latest over silver (expected 0 differences)."""
    p = run_hr(spark, sf)
    return hr360.consistency(p.catalog.read("gold_employees_current"), p.catalog.read("silver_employees"))


@register("hr_active_by_bracket", _sql(f"""
SELECT {_AGE_CASE} AS age_bracket, COUNT(*) AS employees FROM emp_current WHERE status = 'Active' GROUP BY 1
"""))
def q_hr_active_by_bracket(spark, sf):
    """Active employees per age bracket."""
    return hr360.active_by_bracket(run_hr(spark, sf).catalog.read("gold_employees_current"))


@register("hr_days_by_bu_type", _sql("""
SELECT e.business_unit, a.absence_type, CAST(SUM(a.days) AS BIGINT) AS total_absence_days
FROM abs_kept a JOIN emp_current e ON upper(trim(a.employee_id)) = upper(trim(e.employee_id))
GROUP BY ALL
"""))
def q_hr_days_by_bu_type(spark, sf):
    """Re-aggregation of the stored absenteeism table by business unit and type."""
    p = run_hr(spark, sf)
    r = hr360.rollups(p.catalog.read("gold_absenteeism_by_department"),
                      p.catalog.read("gold_absence_reasons_by_department"), p.catalog.read("gold_employee_360"))
    return r["days_by_bu_type"].withColumn("total_absence_days", F.col("total_absence_days").cast("long"))


_ISLANDS = HISTORY_BODY.split("\nSELECT employee_id, department_id, contract_type, job_title, status")[0]


@register("hr_mobility", _sql(_ISLANDS + """
SELECT employee_id, COUNT(*) AS versions FROM i GROUP BY employee_id HAVING COUNT(*) >= 2
""").replace(*_FIX))
def q_hr_mobility(spark, sf):
    """Employees with more than one version in the SCD 2 history."""
    from medallion.operators.cdc import multi_version_keys
    return multi_version_keys(run_hr(spark, sf).catalog.read("gold_employees_history"), ["employee_id"], 2)
