"""Hand-made HR landing files: two entities, drafts inside a file, bad rows, a late file, A -> B -> A."""

import json
import os

from medallion.plans.hr360 import DEPARTMENT_SCHEMA, DEPARTMENTS  # noqa: E402,F401

AS_OF = "2026-01-01"


def emp(eid, dept, job="Analyst", contract="CDI", birth="1990-05-01", hire="2015-03-01", status="Active",
        gender="F", extract="2024-01-01", ts="2024-01-01T08:00:00.000000", upd=None):
    return {"employee_id": eid, "first_name": "jean-pierre de la", "last_name": "martin", "gender": gender,
            "birth_date": birth, "hire_date": hire, "department_id": dept, "job_title": job,
            "contract_type": contract, "work_location": "Lyon", "manager_id": "EMPFR0000001",
            "email": f"{eid}@Example.com", "fte": 1.0, "status": status, "extract_date": extract,
            "extract_ts": ts, "updated_at": upd or ts}


def write_lines(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        for r in rows:
            f.write((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n")


T1 = "2024-01-01T08:00:00.000000"
T2 = "2024-01-08T08:00:00.000000"
T_LATE = "2024-01-05T08:00:00.000000"


def fr_seed():
    return [
        emp("EMPFR0000001", "D001"),
        emp("EMPFR0000002", "D002", upd="2024-01-01T06:00:00.000000"),  # draft, corrected below
        emp("EMPFR0000002", "D003", job="Manager"),
        emp("EMPFR0000003", "D003"),
        emp("EMPFR0000004", "D004", gender="M"),
        emp("EMPFR0000005", "D004", contract="CDD"),
        # bad rows, one broken rule each
        emp("EMPFR9990001", "D001", birth="2014-06-01"),  # plausible_age (drop)
        emp("EMPFR9990002", "D001", birth="1945-01-01", hire="1970-01-01"),  # plausible_age (drop)
        emp("EMPFR9990003", "D001", birth=None),  # valid_birth_date (drop) only
        emp("EMPFR9990004", "D001", birth="1990-01-01", hire="1985-01-01"),  # valid_hire_date (drop)
        emp("EMPFR9990005", "D999"),  # known_department (warn, kept)
        emp("EMPFR9990006", "D002", contract="Freelance"),  # valid_contract (warn, kept)
    ]


def fr_increment():
    e = dict(extract="2024-01-08", ts=T2)
    return [
        emp("EMPFR0000001", "D002", **e),  # move
        emp("EMPFR0000002", "D003", job="Manager", **e),
        emp("EMPFR0000003", "D003", job="Lead", **e),  # promotion
        emp("EMPFR0000004", "D004", gender="M", status="Inactive", **e),  # leaver
        emp("EMPFR0000005", "D004", contract="CDD", **e),  # back to D004 (A -> B -> A with the late file)
        emp("EMPFR0000010", "D005", hire="2023-12-01", **e),  # hire
    ]


def fr_late():
    e = dict(extract="2024-01-05", ts=T_LATE)
    return [emp("EMPFR0000001", "D005", **e), emp("EMPFR0000005", "D006", contract="CDD", **e)]


def be_seed():
    e = dict(ts="2024-01-02T09:00:00.000000", extract="2024-01-02")
    return [emp("EMPBE0000001", "D007", **e), emp("EMPBE0000002", "D008", gender="M", **e),
            emp("EMPBE0000003", "D009", contract="Stage", **e)]


def absences():
    def a(aid, eid, typ, start, end, days, comment=None):
        r = {"absence_id": aid, "employee_id": eid, "absence_type": typ, "start_date": start, "end_date": end,
             "days": days, "event_timestamp": f"{start}T08:00:00"}
        if comment is not None:
            r["comment"] = comment
        return r
    return [
        a("ABS-FR-1-0000001", "EMPFR0000001", "Maladie", "2026-01-05", "2026-01-07", 3, "Rendez-vous médecin"),
        a("ABS-FR-1-0000002", "EMPFR0000001", "RTT", "2026-02-02", "2026-02-02", 1, "  "),
        a("ABS-FR-1-0000003", "empfr0000003 ", "Formation", "2026-03-02", "2026-03-03", 2, "Formation sécurité"),
        a("ABS-FR-1-0000004", "EMPFR0000003", "Congés payés", "2025-12-22", "2025-12-26", 5,
          "Mariage de ma soeur"),
        a("ABS-FR-1-0000005", "EMPFR0000002", "Maladie", "2026-01-12", "2026-01-13", 2, "Rendez-vous médecin"),
        a("ABS-FR-1-9000001", None, "RTT", "2026-01-05", "2026-01-05", 1),  # valid_employee (drop)
        a("ABS-FR-1-9000002", "EMPFR0000001", "RTT", "2026-01-09", "2026-01-08", 1),  # valid_dates (drop)
        a("ABS-FR-1-9000003", "EMPFR0000001", "RTT", "2026-01-05", "2026-01-05", 0),  # positive_days (drop)
        a("ABS-FR-1-9000004", "EMPFR0000002", None, "2026-01-20", "2026-01-20", 1),  # known_type (warn)
    ]
