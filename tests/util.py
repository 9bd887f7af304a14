"""Small literal inputs."""

from datetime import datetime

from tallystar import schemas

RUN_TS = "2030-01-01 00:00:00"


def at(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


BASE = {
    "user_id": "U1",
    "username": "ann",
    "session_id": "S1",
    "device_type": "Web",
    "app_version": "2.0",
    "watch_time": 1.0,
    "country": "IN",
    "city": "CP",
    "region_code": "NCR-CP",
    "lat": 28.62,
    "lon": 77.21,
    "company_id": "C1",
    "company_name": "Acme",
    "branch_id": "B1",
    "branch_name": "North",
    "department": "Sales",
    "manager_id": "M1",
    "manager_name": "Mia",
    "employee_id": "E1",
    "employee_name": "Ed",
    "project_code": "P1",
    "project_name": "Pro",
}


def raw_frame(spark, *events: dict):
    """RAW rows: every event names event_id and event_ts and what differs from BASE."""
    rows = []
    for event in events:
        row = {**BASE, **event}
        ts = row["event_ts"]
        row["event_ts"] = at(ts) if isinstance(ts, str) else ts
        row.setdefault("ingestion_ts", at("2024-02-01 00:00:00"))
        rows.append(tuple(row[c] for c in schemas.RAW.names))
    return spark.createDataFrame(rows, schemas.RAW)


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())
