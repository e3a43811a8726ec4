"""The people-analytics application (Z1–Z18) built from the library.

Entities deliver JSON-lines extracts of employees and absence events into one landing folder each.  The
pipeline ingests every entity as its own append flow into one bronze table per dataset, types and checks
the rows into silver (expectations), keeps the current state (SCD 1) and the history of department /
contract / job changes (SCD 2) per employee, and refreshes the materialized views: last delivered extract,
the employee 360 view and the three consumption KPI tables.  ``as_of`` pins "today" for ages, seniority
and year-to-date figures so a run can be reproduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.columns import (
    AGE_BRACKETS, AGE_ELSE, SENIORITY_BRACKETS, SENIORITY_ELSE, age_years, bracket, seniority_years,
)
from medallion.operators import cdc, sets, windows
from medallion.operators.classify import HR_REASON_PATTERNS, classify
from medallion.operators.filter import split_filter
from medallion.operators.join import join
from medallion.operators.quality import Expectation
from medallion.operators.sqlnode import expression_select
from medallion.operators.unique import unique
from medallion.sources.tables import PipelineConfig
from medallion.streaming.flows import CdcSpec, Dataset, Pipeline, View

# ----------------------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results): entity codes, contract types, quality rules,
# CDC keys / sequence / tracked columns.
ENTITIES = ["FR", "BE"]
CONTRACT_TYPES = ["CDI", "CDD", "Alternance", "Stage", "Intérim"]
EMPLOYEE_RULES = [
    Expectation("valid_employee_id", "employee_id IS NOT NULL", "fail"),
    Expectation("valid_birth_date", "birth_date IS NOT NULL AND birth_date > DATE'1940-01-01'", "drop"),
    Expectation("valid_hire_date", "hire_date IS NOT NULL AND hire_date >= birth_date", "drop"),
    Expectation("plausible_age", "age BETWEEN 16 AND 75", "drop"),
    Expectation("known_department", "department_name IS NOT NULL", "warn"),
    Expectation("valid_contract", "contract_type IN ('CDI','CDD','Alternance','Stage','Intérim')", "warn"),
    Expectation("valid_entity", "source_entity IN ('FR','BE')", "drop"),
]
ABSENCE_RULES = [
    Expectation("valid_absence_id", "absence_id IS NOT NULL", "fail"),
    Expectation("valid_employee", "employee_id IS NOT NULL", "drop"),
    Expectation("valid_dates", "start_date IS NOT NULL AND end_date >= start_date", "drop"),
    Expectation("positive_days", "days > 0 AND days <= 365", "drop"),
    Expectation("known_type", "absence_type IS NOT NULL", "warn"),
]
EMPLOYEE_KEYS = ["employee_id"]
EMPLOYEE_SEQUENCE = ["extract_ts", "updated_at"]
TRACKED = ["department_id", "contract_type", "job_title"]
DEPARTMENT_COLUMNS = ["department_id", "department_name", "business_unit", "region", "country", "cost_center"]
# ----------------------------------------------------------------------------------------------------------

# Our own master data: 12 departments (the reference's master rows are not reproduced).
DEPARTMENTS = [
    ("D001", "Finance", "Corporate", "North", "FR", "CC100"),
    ("D002", "Payroll", "Corporate", "North", "FR", "CC110"),
    ("D003", "Sales East", "Commercial", "East", "FR", "CC200"),
    ("D004", "Sales West", "Commercial", "West", "FR", "CC210"),
    ("D005", "Logistics", "Operations", "South", "FR", "CC300"),
    ("D006", "Plant A", "Operations", "South", "FR", "CC310"),
    ("D007", "Research", "Technology", "North", "BE", "CC400"),
    ("D008", "IT Support", "Technology", "North", "BE", "CC410"),
    ("D009", "Marketing", "Commercial", "Central", "BE", "CC220"),
    ("D010", "Legal", "Corporate", "Central", "BE", "CC120"),
    ("D011", "Plant B", "Operations", "Central", "BE", "CC320"),
    ("D012", "People", "Corporate", "Central", "BE", "CC130"),
]
DEPARTMENT_SCHEMA = ("department_id string, department_name string, business_unit string, region string, "
                     "country string, cost_center string")

SILVER_EMPLOYEE_COLUMNS = [
    "source_entity", "employee_id", "extract_date", "extract_ts", "updated_at", "_source_file", "first_name",
    "last_name", "gender", "birth_date", "age", "hire_date", "seniority_years", "job_title", "contract_type",
    "work_location", "manager_id", "email", "fte", "status", "department_id",
]


def _ts(c: str):
    return F.try_to_timestamp(F.col(c).cast("string"))


def _date(c: str):
    return F.try_to_date(F.col(c).cast("string"))


# How a delivered field becomes typed, by its silver type; everything else is text as it came.
TYPED_AS = {"date": ("extract_date", "birth_date", "hire_date"), "time": ("extract_ts", "updated_at"),
            "number": ("fte",), "capitalised": ("first_name",), "upper": ("last_name",), "lower": ("email",)}
READERS = {"date": _date, "time": _ts, "number": lambda c: F.col(c).cast("double"), "capitalised": F.initcap,
           "upper": F.upper, "lower": F.lower}


def silver_employees(bronze: DataFrame, departments: DataFrame, as_of=None) -> DataFrame:
    """Employee rows with their types, derived ages and master data (Z2).  Text that can't be read becomes NULL and so
    reaches the rules."""
    reader = {column: READERS[kind] for kind, columns in TYPED_AS.items() for column in columns}
    delivered = [c for c in SILVER_EMPLOYEE_COLUMNS if c not in ("age", "seniority_years")]
    typed = bronze.select(*(reader.get(c, F.col)(c).alias(c) for c in delivered))
    derived = {"age": age_years(F.col("birth_date"), as_of), "seniority_years": seniority_years(F.col("hire_date"), as_of)}
    brackets = {"age_bracket": bracket(F.col("age"), AGE_BRACKETS, AGE_ELSE),
                "seniority_bracket": bracket(F.col("seniority_years"), SENIORITY_BRACKETS, SENIORITY_ELSE)}
    return typed.withColumns(derived).join(departments.select(*DEPARTMENT_COLUMNS), "department_id", "left") \
        .select(*SILVER_EMPLOYEE_COLUMNS, *DEPARTMENT_COLUMNS[1:], *(v.alias(k) for k, v in brackets.items()))


def silver_absences(bronze: DataFrame) -> DataFrame:
    """Typed absence events (Z3)."""
    return bronze.select(
        "source_entity", "absence_id", "employee_id", "absence_type",
        _date("start_date").alias("start_date"), _date("end_date").alias("end_date"),
        F.col("days").cast("int").alias("days"), _ts("event_timestamp").alias("event_timestamp"),
        F.date_trunc("month", _date("start_date")).alias("absence_month"),
        F.nullif(F.trim(F.col("comment").cast("string")), F.lit("")).alias("comment"))


def datasets(departments: DataFrame, as_of=None, buckets: int = 16) -> tuple[Dataset, Dataset]:
    employees = Dataset(
        bronze="bronze_employees", silver="silver_employees",
        transform=lambda b: silver_employees(b, departments, as_of), expectations=EMPLOYEE_RULES,
        cdc=[CdcSpec("gold_employees_current", EMPLOYEE_KEYS, EMPLOYEE_SEQUENCE, 1),
             CdcSpec("gold_employees_history", EMPLOYEE_KEYS, EMPLOYEE_SEQUENCE, 2, TRACKED)],
        buckets=buckets,
        describe={
            "bronze_employees": {"comment": "Raw employee extracts of every entity", "properties": {"quality": "bronze"}},
            "silver_employees": {"comment": "Employees typed, derived, checked and joined to departments",
                                 "properties": {"quality": "silver"}},
            "gold_employees_current": {"comment": "Current state per employee (SCD 1)",
                                       "properties": {"quality": "gold"}},
            "gold_employees_history": {"comment": "Department / contract / job history per employee (SCD 2)",
                                       "properties": {"quality": "gold"}},
        })
    absences = Dataset(bronze="bronze_absences", silver="silver_absences", transform=silver_absences,
                       expectations=ABSENCE_RULES, buckets=buckets,
                       describe={"silver_absences": {"comment": "Absence events typed and checked",
                                                     "properties": {"quality": "silver"}}})
    return employees, absences


# ---------------------------------------------------------------------------------------- materialized views
def last_extract(silver: DataFrame) -> DataFrame:
    """Newest delivered file per entity, one row per employee with versions and previous values."""
    return windows.last_delivery_latest(
        silver, entity=["source_entity"], key=["employee_id"], file_col="_source_file", file_order="extract_ts",
        version_order=["updated_at"],
        previous={"previous_department_id": "department_id", "previous_job_title": "job_title"})


def employee_360(current: DataFrame, absences: DataFrame, as_of=None) -> DataFrame:
    """Active employees with year-to-date absence days and events (zero when none)."""
    import datetime as _dt
    year = (_dt.date.today() if as_of is None else _dt.date.fromisoformat(str(as_of)[:10])).year
    # a date range (not year(col) = ...) so the predicate reaches the Parquet scan and its statistics
    in_year = (F.col("start_date") >= F.lit(f"{year}-01-01").cast("date")) & \
        (F.col("start_date") < F.lit(f"{year + 1}-01-01").cast("date"))
    ytd = (absences.where(in_year).groupBy("employee_id")
           .agg(F.sum("days").alias("absence_days_ytd"), F.count(F.lit(1)).alias("absence_events_ytd")))
    active = current.where(F.col("status") == "Active")
    j = active.join(ytd, "employee_id", "left")
    return j.select(*active.columns, F.coalesce("absence_days_ytd", F.lit(0)).cast("long").alias("absence_days_ytd"),
                    F.coalesce("absence_events_ytd", F.lit(0)).cast("long").alias("absence_events_ytd"))


def headcount(current: DataFrame) -> DataFrame:
    """Key figures of the active employees of each department (fixed values: the names of the figures)."""
    active = split_filter(current, "status = 'Active'")["filtered_data"]
    women = F.count_if(F.col("gender") == "F")
    figures = {
        "headcount": F.count("*"),
        "avg_age": F.round(F.avg("age"), 1),
        "avg_seniority_years": F.round(F.avg(F.col("seniority_years").cast("double")), 1),
        "cdi_count": F.count_if(F.col("contract_type") == "CDI"),
        "female_count": women,
        "female_pct": F.round(women.cast("decimal(20,0)") * 100 / F.count("*"), 1).cast("double"),
    }
    place = [c for c in DEPARTMENT_COLUMNS if c not in ("country", "cost_center")]
    return active.groupBy(*place).agg(*(figure.alias(name) for name, figure in figures.items()))


def absenteeism(absences: DataFrame, current: DataFrame) -> DataFrame:
    """Absences joined to employees (keys case/space-insensitive), by department × month × type."""
    j = join([absences, current.select("employee_id", "department_id", "department_name", "business_unit")],
             "inner", match_case=False,
             conditions=[{"left_input": 0, "right_input": 1,
                          "join_keys": [{"left": "employee_id", "right": "employee_id"}]}])["joined_data"]
    agg = j.groupBy("department_id", "department_name", "business_unit", "absence_month", "absence_type").agg(
        F.count_distinct("employee_id").alias("employees_absent"),
        F.count("absence_id").alias("absence_events"),
        F.sum("days").cast("long").alias("total_absence_days"))
    return agg.withColumn("avg_days_per_absence",
                          F.round(F.col("total_absence_days") / F.col("absence_events"), 1))


def absence_reasons(absences: DataFrame, current: DataFrame, patterns=None) -> DataFrame:
    """Classify each distinct comment once, extract the label, join back, aggregate by department."""
    with_text = split_filter(absences, "comment IS NOT NULL")["filtered_data"]
    texts = unique(with_text.select("comment"), ["comment"], all_columns=False)
    labelled = classify(texts, "comment", patterns or HR_REASON_PATTERNS, "reason_category_json")
    labelled = expression_select(
        labelled, ["get_json_object(reason_category_json, '$.response[0]') AS reason_category"])
    back = join([absences, labelled], "inner", match_case=True, conditions=[
        {"left_input": 0, "right_input": 1, "join_keys": [{"left": "comment", "right": "comment"}]}])["joined_data"]
    emp = current.select("employee_id", "department_name", "business_unit")
    j = join([back, emp], "inner", match_case=False, conditions=[
        {"left_input": 0, "right_input": 1, "join_keys": [{"left": "employee_id", "right": "employee_id"}]}]
    )["joined_data"]
    return j.groupBy("department_name", "business_unit", "reason_category").agg(
        F.count("absence_id").alias("absence_events"), F.sum("days").cast("long").alias("total_absence_days"))


def views(as_of=None) -> dict:
    """Materialized views, each declared by the tables it reads (refreshed after the flows)."""
    current, absences = "gold_employees_current", "silver_absences"
    return {
        "silver_employees_last_extract": View(("silver_employees",), last_extract),
        "gold_employee_360": View((current, absences), lambda c, a: employee_360(c, a, as_of)),
        "gold_headcount_by_department": View((current,), headcount),
        "gold_absenteeism_by_department": View((absences, current), absenteeism),
        "gold_absence_reasons_by_department": View((absences, current), absence_reasons),
    }


def run_update(spark: SparkSession, cfg: PipelineConfig, departments: DataFrame, buckets: int = 16) -> Pipeline:
    """One pipeline update: every entity flow (new files only), then the materialized views."""
    p = Pipeline(spark, cfg.root)
    p.catalog.table("departments").overwrite(departments)  # S10 master data, overwritten on rebuild
    # silver reads the stored table, as any other consumer of the master data
    emp, abs_ = datasets(p.catalog.read("departments"), cfg.as_of, buckets)
    p.run([(emp, cfg.employee_flows()), (abs_, cfg.absence_flows())], views(cfg.as_of),
          max_files_per_trigger=cfg.max_files_per_trigger)
    return p


# ---------------------------------------------------------------------------------------- validation queries
def rows_files_keys(bronze: DataFrame) -> DataFrame:
    """Rows, files and distinct employees per entity."""
    return bronze.groupBy("source_entity").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_source_file").alias("files"),
        F.count_distinct("employee_id").alias("employees"))


def duplicates_histogram(silver: DataFrame) -> DataFrame:
    """How many employees appear n times inside one file."""
    per = silver.groupBy("source_entity", "_source_file", "employee_id").agg(F.count(F.lit(1)).alias("versions"))
    return per.groupBy("versions").agg(F.count(F.lit(1)).alias("employees"))


def correction_report(last: DataFrame, k: int = 20) -> DataFrame:
    """Employees corrected inside the last file (previous vs current values), top k."""
    return windows.corrections(last, [F.col("updated_at").desc(), F.col("employee_id")], k).select(
        "source_entity", "employee_id", "versions_in_file", "previous_department_id", "department_id",
        "previous_job_title", "job_title", "updated_at")


def key_listing(silver: DataFrame, last: DataFrame, employee_id: str) -> DataFrame:
    """The rows of one employee in its last file, before/after, as one listing (CTE + J2 + U1)."""
    rows = silver.where(F.col("employee_id") == employee_id).select(
        F.lit("version").alias("kind"), "employee_id", "updated_at", "department_id", "job_title")
    newest = last.where(F.col("employee_id") == employee_id).select(
        F.lit("latest").alias("kind"), "employee_id", "updated_at", "department_id", "job_title")
    return sets.union_all([rows, newest])


def consistency(current: DataFrame, silver: DataFrame) -> DataFrame:
    """SCD 1 current state vs keep-latest over silver — expected 0 differences."""
    latest = windows.latest_per_key(silver, EMPLOYEE_KEYS, EMPLOYEE_SEQUENCE, count_as=None)
    return cdc.count_differences(current, latest, EMPLOYEE_KEYS, ["department_id", "job_title", "status"])


def active_by_bracket(current: DataFrame) -> DataFrame:
    """Active employees per age bracket."""
    return (current.where(F.col("status") == "Active").groupBy("age_bracket")
            .agg(F.count(F.lit(1)).alias("employees")))


def mobility(history: DataFrame) -> DataFrame:
    """Versions of employees with more than one version, in order."""
    multi = cdc.multi_version_keys(history, EMPLOYEE_KEYS, 2)
    return (history.join(multi.select("employee_id"), "employee_id", "left_semi")
            .select("employee_id", "department_id", "contract_type", "job_title",
                    F.col(f"{cdc.START_AT}.extract_ts").alias("start_extract_ts"),
                    F.col(f"{cdc.END_AT}.extract_ts").alias("end_extract_ts")))


def rollups(absenteeism_df: DataFrame, reasons_df: DataFrame, e360: DataFrame, k: int = 20) -> dict:
    """Re-aggregations of stored aggregates, work-related reasons, top absentees."""
    return {
        "days_by_bu_type": absenteeism_df.groupBy("business_unit", "absence_type").agg(
            F.sum("total_absence_days").alias("total_absence_days")),
        "days_by_reason": reasons_df.groupBy("reason_category").agg(
            F.sum("total_absence_days").alias("total_absence_days")),
        "work_related": reasons_df.where(F.col("reason_category") == "lié au travail"),
        "top_absentees": e360.orderBy(F.col("absence_days_ytd").desc(), F.col("employee_id")).limit(k)
        .select("employee_id", "department_name", "absence_days_ytd", "absence_events_ytd"),
    }

