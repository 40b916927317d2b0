"""Small hand-written inputs."""

from plateward.plans.staging import build_staging

RAW_SCHEMA = (
    "inspection_id bigint, dba_name string, aka_name string, license_number string,"
    " facility_type string, risk string, address string, city string, state string, zip string,"
    " inspection_date string, inspection_type string, results string, violations string,"
    " latitude double, longitude double, location string, ingested_at timestamp"
)
DEFAULTS = dict(
    dba_name=" Cafe ", aka_name="Cafe", license_number="7", facility_type="Restaurant",
    risk="Risk 1 (High)", address="1 Main St", city="CHICAGO", state="IL", zip="60601",
    inspection_date="01/02/2020", inspection_type="Canvass", results="Pass",
    violations="1. dirty", latitude=41.5, longitude=-87.5, location="here", ingested_at=None,
)


def raw(spark, rows):
    """Raw inspections: each row names only what differs; ids count from 1."""
    names = [part.split()[0] for part in RAW_SCHEMA.split(", ")]
    full = [{"inspection_id": i, **DEFAULTS, **row} for i, row in enumerate(rows, 1)]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in full], RAW_SCHEMA)


def staged(spark, rows):
    return build_staging(raw(spark, rows))


def column(df, name, key="inspection_id"):
    return [row[name] for row in df.orderBy(key).select(name).collect()]
