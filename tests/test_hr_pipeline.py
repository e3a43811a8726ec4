import glob
import os

import pytest
from pyspark.sql import functions as F

from medallion.operators import cdc
from medallion.plans import hr360
from medallion.sources.tables import PipelineConfig
from medallion.streaming.flows import METRICS_TABLE, quality_summary

from hr_fixtures import (AS_OF, DEPARTMENT_SCHEMA, DEPARTMENTS, absences, be_seed, fr_increment, fr_late, fr_seed,
                         write_lines)


@pytest.fixture(scope="module")
def hr(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("hr"))
    land = {e: os.path.join(root, f"landing_{e}") for e in ("FR", "BE")}
    write_lines(f"{land['FR']}/employees", "employees_seed_20240101_080000.json", fr_seed())
    write_lines(f"{land['FR']}/employees", "employees_increment_20240108_080000.json", fr_increment())
    write_lines(f"{land['BE']}/employees", "employees_seed_20240102_090000.json", be_seed())
    write_lines(f"{land['FR']}/absences", "absences_seed_20240101.json", absences())
    cfg = PipelineConfig(root=f"{root}/lake", as_of=AS_OF,
                         employees={e: f"{land[e]}/employees" for e in land},
                         absences={"FR": f"{land['FR']}/absences"})
    deps = spark.createDataFrame(DEPARTMENTS, DEPARTMENT_SCHEMA)
    p = hr360.run_update(spark, cfg, deps, buckets=4)
    first_bronze = p.catalog.read("bronze_employees").count()
    # the late file arrives after the newer one; a second update processes only it
    write_lines(f"{land['FR']}/employees", "employees_increment_20240105_080000.json", fr_late())
    p = hr360.run_update(spark, cfg, deps, buckets=4)
    # a third update with no new file changes nothing
    p = hr360.run_update(spark, cfg, deps, buckets=4)
    return p, first_bronze


def test_bronze_incremental_no_duplicates(hr):
    p, first = hr
    b = p.catalog.read("bronze_employees")
    assert first == len(fr_seed()) + len(fr_increment()) + len(be_seed())
    assert b.count() == first + len(fr_late())
    assert {r[0] for r in b.select("source_entity").distinct().collect()} == {"FR", "BE"}
    assert b.where("_source_file IS NULL OR _ingested_at IS NULL").count() == 0


def test_silver_quality(hr):
    p, _ = hr
    s = p.catalog.read("silver_employees")
    ids = {r[0] for r in s.select("employee_id").collect()}
    assert "EMPFR9990005" in ids and "EMPFR9990006" in ids  # warned rows survive
    assert not ids & {"EMPFR9990001", "EMPFR9990002", "EMPFR9990003", "EMPFR9990004"}
    m = {r["rule"]: r["failed"] for r in quality_summary(p, "silver_employees").collect()}
    assert m == {"valid_employee_id": 0, "valid_birth_date": 1, "valid_hire_date": 1, "plausible_age": 2,
                 "known_department": 1, "valid_contract": 1, "valid_entity": 0}
    q = p.catalog.read("silver_employees_quarantine")
    assert q.count() == 4
    row = s.where("employee_id = 'EMPFR0000001'").orderBy("extract_ts").first()
    assert row["first_name"] == "Jean-pierre De La" and row["last_name"] == "MARTIN"
    assert row["age"] == 35 and row["age_bracket"] == "35-44" and row["seniority_bracket"] == "10-20 ans"
    assert s.schema["seniority_years"].dataType.simpleString().startswith("decimal")
    a = {r["rule"]: r["failed"] for r in quality_summary(p, "silver_absences").collect()}
    assert a == {"valid_absence_id": 0, "valid_employee": 1, "valid_dates": 1, "positive_days": 1, "known_type": 1}
    assert p.catalog.read(METRICS_TABLE).where("dataset = 'silver_absences'").count() == 5


def test_gold_current_and_history(hr):
    p, _ = hr
    cur = {r["employee_id"]: r for r in p.catalog.read("gold_employees_current").collect()}
    assert cur["EMPFR0000001"]["department_id"] == "D002"  # newest sequence wins, not the late file
    assert cur["EMPFR0000004"]["status"] == "Inactive"
    assert cur["EMPFR0000002"]["department_id"] == "D003"  # in-file correction
    h = p.catalog.read("gold_employees_history")
    e1 = [(r["department_id"], r["s"], r["e"]) for r in h.where("employee_id = 'EMPFR0000001'").select(
        "department_id", F.col(f"{cdc.START_AT}.extract_ts").alias("s"),
        F.col(f"{cdc.END_AT}.extract_ts").alias("e")).orderBy("s").collect()]
    assert [d for d, _, _ in e1] == ["D001", "D005", "D002"] and e1[-1][2] is None
    e5 = [r[0] for r in h.where("employee_id = 'EMPFR0000005'").orderBy(f"{cdc.START_AT}").select(
        "department_id").collect()]
    assert e5 == ["D004", "D006", "D004"]  # A -> B -> A: three versions
    e2 = h.where("employee_id = 'EMPFR0000002'").count()
    assert e2 == 2  # draft D002 then D003 inside the first file: a very short version is kept
    assert hr360.consistency(p.catalog.read("gold_employees_current"),
                             p.catalog.read("silver_employees")).collect()[0][0] == 0


def test_views(hr):
    p, _ = hr
    last = p.catalog.read("silver_employees_last_extract")
    fr = {r["employee_id"]: r for r in last.where("source_entity = 'FR'").collect()}
    # the newest FR file is the 2024-01-08 increment (the late file has an older extract_ts)
    assert "EMPFR0000010" in fr and fr["EMPFR0000001"]["versions_in_file"] == 1
    hc = {r["department_id"]: r for r in p.catalog.read("gold_headcount_by_department").collect()}
    assert "D999" in hc  # the warned row is counted: 13th group possible
    e360 = {r["employee_id"]: r for r in p.catalog.read("gold_employee_360").collect()}
    assert "EMPFR0000004" not in e360  # inactive
    assert e360["EMPFR0000001"]["absence_days_ytd"] == 4 and e360["EMPFR0000001"]["absence_events_ytd"] == 2
    # the 360 view joins ids exactly (as SQL does): the padded lower-case id and the 2025 absence do not count
    assert e360["EMPFR0000003"]["absence_days_ytd"] == 0
    ab = p.catalog.read("gold_absenteeism_by_department")
    # the lower-case, padded employee id still joins (case/space-insensitive keys)
    assert ab.where("absence_type = 'Formation'").count() == 1
    rs = {r["reason_category"]: r["absence_events"] for r in p.catalog.read("gold_absence_reasons_by_department")
          .groupBy("reason_category").agg(F.sum("absence_events").alias("absence_events")).collect()}
    assert rs == {"santé": 2, "famille": 1, "formation": 1}  # padded lower-case id joins (case-insensitive)


def test_fail_rule_stops_the_batch(spark, tmp):
    land = os.path.join(tmp, "landing")
    bad = [dict(r) for r in fr_seed()[:2]]
    bad[1]["employee_id"] = None
    write_lines(land, "employees_seed.json", bad)
    cfg = PipelineConfig(root=os.path.join(tmp, "lake"), as_of=AS_OF, employees={"FR": land})
    deps = spark.createDataFrame(DEPARTMENTS, DEPARTMENT_SCHEMA)
    with pytest.raises(Exception, match="valid_employee_id"):
        hr360.run_update(spark, cfg, deps, buckets=4)
    from medallion.sinks.tables import Catalog
    c = Catalog(spark, os.path.join(tmp, "lake", "tables"))
    assert c.read("bronze_employees").count() == 2  # bronze has no expectations
    assert not c.table("silver_employees").exists() or c.read("silver_employees").count() == 0


def test_validation_queries(hr, spark):
    p, _ = hr
    silver, bronze = p.catalog.read("silver_employees"), p.catalog.read("bronze_employees")
    last = p.catalog.read("silver_employees_last_extract")
    rf = {r["source_entity"]: (r["rows"], r["files"]) for r in hr360.rows_files_keys(bronze).collect()}
    assert rf == {"FR": (20, 3), "BE": (3, 1)}
    hist = {r["versions"]: r["employees"] for r in hr360.duplicates_histogram(silver).collect()}
    assert hist[2] == 1  # EMPFR0000002: draft + final in the seed file
    assert hr360.correction_report(last).count() == 0  # no correction inside the newest files
    listing = hr360.key_listing(silver, last, "EMPFR0000001")
    assert sorted(r["kind"] for r in listing.collect()) == ["latest", "version", "version", "version"]
    brackets = {r["age_bracket"]: r["employees"] for r in hr360.active_by_bracket(
        p.catalog.read("gold_employees_current")).collect()}
    assert brackets == {"35-44": 10}  # 7 active FR (one leaver) + 3 BE, all born in 1990
    mob = hr360.mobility(p.catalog.read("gold_employees_history"))
    assert {r["employee_id"] for r in mob.collect()} == {"EMPFR0000001", "EMPFR0000002", "EMPFR0000003",
                                                       "EMPFR0000005"}
    r = hr360.rollups(p.catalog.read("gold_absenteeism_by_department"),
                      p.catalog.read("gold_absence_reasons_by_department"), p.catalog.read("gold_employee_360"))
    assert {x["absence_type"] for x in r["days_by_bu_type"].collect()} >= {"Maladie", "RTT"}
    assert r["work_related"].count() == 0 and r["top_absentees"].count() <= 20


def test_full_refresh_equals_incremental(hr, spark):
    p, _ = hr
    from medallion.operators.sets import compare_tables
    before = p.catalog.read("gold_employees_history")
    snapshot = before.select("employee_id", "department_id", "job_title", "contract_type",
                             F.col(f"{cdc.START_AT}.extract_ts").alias("s")).collect()
    emp, abs_ = hr360.datasets(p.catalog.read("departments"), AS_OF, buckets=4)
    import glob
    root = os.path.dirname(p.root)
    flows = [f for f in hr360.PipelineConfig(root=p.root, employees={
        "FR": f"{root}/landing_FR/employees", "BE": f"{root}/landing_BE/employees"}).employee_flows()]
    assert glob.glob(f"{root}/landing_FR/employees/*.json")
    p.full_refresh([(emp, flows)])
    after = p.catalog.read("gold_employees_history").select(
        "employee_id", "department_id", "job_title", "contract_type", F.col(f"{cdc.START_AT}.extract_ts").alias("s"))
    assert compare_tables(spark.createDataFrame(snapshot, after.schema), after).collect()[0]["identical"]


def test_table_descriptions(hr):
    p, _ = hr
    m = p.catalog.table("gold_employees_history").manifest()
    assert m.comment.startswith("Department") and m.properties == {"quality": "gold"}
    assert p.catalog.table("silver_absences").manifest().properties == {"quality": "silver"}


def test_absences_land_in_as_many_files_as_their_size_asks_for(spark, tmp):
    from medallion.plans.hr_driver import land_absences, land_employees
    sf, size = "/root/testdata/sf0.01", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.read.parquet(f"{sf}/customer.parquet").write.parquet(f"{tmp}/customer.parquet")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    orders.repartition(6).write.parquet(f"{tmp}/orders.parquet")
    old = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        land_absences(spark, tmp, f"{tmp}/absences")
        land_employees(spark, tmp, f"{tmp}/employees", late=True)
    finally:
        spark.conf.set(size, old)
    found = {e: len(glob.glob(f"{tmp}/absences/source_entity={e}/*.txt")) for e in ("FR", "BE")}
    assert min(found.values()) > 1, found
    lines = spark.read.text(f"{tmp}/absences").count()
    assert lines == orders.count()
    assert all(len(glob.glob(f"{tmp}/employees/source_entity={e}/*.txt")) == 1 for e in ("FR", "BE"))  # a file: a delivery
