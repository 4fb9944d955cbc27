"""Declared source schemas, source specs and join contracts.

Schemas are declared, never inferred.  ``SourceSpec`` carries the
required-column list and the type hints that the contract checks compare
against; ``JoinContract`` names the key pair two sources must share.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

TIMESTAMP_COLUMNS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

ORDERS_SCHEMA = StructType(
    [
        StructField("order_id", StringType(), False),
        StructField("customer_id", StringType(), False),
        StructField("order_status", StringType(), True),
    ]
    + [StructField(c, StringType(), True) for c in TIMESTAMP_COLUMNS]
)

CUSTOMERS_SCHEMA = StructType(
    [
        StructField("customer_id", StringType(), False),
        StructField("customer_unique_id", StringType(), True),
        StructField("customer_zip_code_prefix", IntegerType(), True),
        StructField("customer_city", StringType(), True),
        StructField("customer_state", StringType(), True),
    ]
)

GEOLOCATION_SCHEMA = StructType(
    [
        StructField("geolocation_zip_code_prefix", IntegerType(), False),
        StructField("geolocation_lat", DoubleType(), True),
        StructField("geolocation_lng", DoubleType(), True),
        StructField("geolocation_city", StringType(), True),
        StructField("geolocation_state", StringType(), True),
    ]
)

# Type-hint vocabulary: pandas-style names map onto Spark type families.
TYPE_FAMILIES = {
    "object": "string",
    "string": "string",
    "int64": "integer",
    "int32": "integer",
    "int": "integer",
    "bigint": "integer",
    "float64": "float",
    "double": "float",
    "bool": "boolean",
    "datetime64[ns]": "timestamp",
}


def type_family(dt: DataType | str) -> str:
    """Spark DataType (or hint name) -> coarse family used by contract checks."""
    if isinstance(dt, str):
        return TYPE_FAMILIES.get(dt, dt)
    name = dt.typeName()
    if name in ("string", "varchar", "char"):
        return "string"
    if name in ("byte", "short", "integer", "long"):
        return "integer"
    if name in ("float", "double", "decimal"):
        return "float"
    if name in ("timestamp", "timestamp_ntz", "date"):
        return "timestamp"
    return name


@dataclass(frozen=True)
class SourceSpec:
    name: str
    schema: StructType
    required: tuple[str, ...]
    type_hints: dict = field(default_factory=dict)
    path: str | None = None

    def default_path(self, base_dir: str = ".") -> str:
        """Where the source is expected when no path is given: its own path, or else the default below ``base_dir``.

        Fixed value: ``data_source/<name>.csv``.
        """
        return self.path or f"{base_dir.rstrip('/') or '/'}/data_source/{self.name}.csv"

    def with_path(self, path: str) -> "SourceSpec":
        return SourceSpec(self.name, self.schema, self.required, dict(self.type_hints), path)


@dataclass(frozen=True)
class JoinContract:
    name: str
    left_key: str
    right_key: str
    expected_type: str
    description: str


# ---------------------------------------------------------------------------
# Source names, required columns (the declared schemas above),
# type hints, contract names, key pairs and descriptions must equal the
# original pipeline's source and join-contract definitions:
#   orders       hints order_id, customer_id, order_status: object
#   customers    hints customer_id, customer_unique_id: object; customer_zip_code_prefix: int64
#   geolocation  hints geolocation_zip_code_prefix: int64; geolocation_lat, geolocation_lng: float64
#   orders_vs_customers       customer_id = customer_id, expected object,
#                             "ERP join CRM via customer_id"
#   customers_vs_geolocation  customer_zip_code_prefix = geolocation_zip_code_prefix,
#                             expected int64, "CRM join Logistics via zip code"
# ---------------------------------------------------------------------------
ORDERS_SPEC = SourceSpec(
    "orders",
    ORDERS_SCHEMA,
    tuple(f.name for f in ORDERS_SCHEMA.fields),
    {"order_id": "object", "customer_id": "object", "order_status": "object"},
)
CUSTOMERS_SPEC = SourceSpec(
    "customers",
    CUSTOMERS_SCHEMA,
    tuple(f.name for f in CUSTOMERS_SCHEMA.fields),
    {"customer_id": "object", "customer_unique_id": "object", "customer_zip_code_prefix": "int64"},
)
GEOLOCATION_SPEC = SourceSpec(
    "geolocation",
    GEOLOCATION_SCHEMA,
    tuple(f.name for f in GEOLOCATION_SCHEMA.fields),
    {
        "geolocation_zip_code_prefix": "int64",
        "geolocation_lat": "float64",
        "geolocation_lng": "float64",
    },
)

SOURCE_SPECS = {s.name: s for s in (ORDERS_SPEC, CUSTOMERS_SPEC, GEOLOCATION_SPEC)}

ORDERS_VS_CUSTOMERS = JoinContract(
    "orders_vs_customers", "customer_id", "customer_id", "object", "ERP join CRM via customer_id"
)
CUSTOMERS_VS_GEOLOCATION = JoinContract(
    "customers_vs_geolocation",
    "customer_zip_code_prefix",
    "geolocation_zip_code_prefix",
    "int64",
    "CRM join Logistics via zip code",
)
JOIN_CONTRACTS = {c.name: c for c in (ORDERS_VS_CUSTOMERS, CUSTOMERS_VS_GEOLOCATION)}

BRONZE_COLUMNS = (
    "zip_code",
    "customer_id",
    "order_id",
    "order_status",
    *TIMESTAMP_COLUMNS,
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "geolocation_state",
    "lat",
    "lng",
    "city",
)
