"""Static rows the star schema starts with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar import schemas
from tallystar.sources.rows import literal_rows

# Seed rows of the dimensions.
REGIONS = [
    ("NCR", "North Central Region"),
    ("WST", "Western Region"),
    ("EST", "Eastern Region"),
    ("SOU", "Southern Region"),
    ("NTH", "Northern Region"),
]
COMPANIES = [
    ("C001", "Acme Corp", "Retail"),
    ("C002", "Globex Ltd", "Finance"),
    ("C003", "Innotech", "Technology"),
]
BRANCHES = [
    ("B001", "NCR Branch", "C001", "NCR"),
    ("B002", "Pune Branch", "C001", "WST"),
    ("B003", "Kolkata Branch", "C002", "EST"),
    ("B004", "Bangalore Branch", "C003", "SOU"),
]
MANAGERS = [
    ("M001", "Rohit Sharma", "B001", "Sales"),
    ("M002", "Anjali Mehta", "B002", "Engineering"),
    ("M003", "Karan Patel", "B003", "Finance"),
    ("M004", "Sonal Gupta", "B004", "Product"),
]
PROJECTS = [
    ("P001", "HyperGrowth", "C001", "Sales"),
    ("P002", "NeuralOps", "C003", "Engineering"),
    ("P003", "SafeFinance", "C002", "Finance"),
]
# Region boxes (code, name, city, min/max latitude, min/max longitude).
REGION_BOXES = [
    ("NCR-NOIDA", "Noida", "Delhi NCR", 28.50, 28.65, 77.30, 77.45),
    ("NCR-GGN", "Gurgaon", "Delhi NCR", 28.38, 28.53, 76.90, 77.15),
    ("NCR-SAKET", "Saket", "Delhi NCR", 28.50, 28.55, 77.18, 77.25),
    ("NCR-DWARKA", "Dwarka", "Delhi NCR", 28.55, 28.63, 77.02, 77.10),
    ("NCR-CP", "ConnaughtPlace", "Delhi NCR", 28.61, 28.64, 77.20, 77.24),
]
SEEDED_EMPLOYEES = 20


def seed_employees(spark: SparkSession) -> DataFrame:
    """E1001..E1020; manager, branch and project are chosen by modulo."""
    n = F.col("id")

    def pick(rows: list[tuple]) -> Column:
        return F.get(F.array(*[F.lit(r[0]) for r in rows]), (n % len(rows)).cast("int"))

    return spark.range(1, SEEDED_EMPLOYEES + 1, 1, 1).select(
        F.concat(F.lit("E"), (n + 1000).cast("string")).alias("employee_id"),
        F.concat(F.lit("Employee_"), n.cast("string")).alias("employee_name"),
        pick(MANAGERS).alias("manager_id"),
        pick(BRANCHES).alias("branch_id"),
        pick(PROJECTS).alias("project_code"),
    )


def seed_region_boxes(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, REGION_BOXES, schemas.DIM_REGION_BOX)


def seed_regions(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, REGIONS, schemas.DIM_REGION)


def seed_dims(spark: SparkSession) -> dict[str, DataFrame]:
    """Seed rows by table name."""
    return {
        "dim_region": seed_regions(spark),
        "dim_company": literal_rows(spark, COMPANIES, schemas.DIM_COMPANY),
        "dim_branch": literal_rows(spark, BRANCHES, schemas.DIM_BRANCH),
        "dim_manager": literal_rows(spark, MANAGERS, schemas.DIM_MANAGER),
        "dim_project": literal_rows(spark, PROJECTS, schemas.DIM_PROJECT),
        "dim_employee": seed_employees(spark),
    }
