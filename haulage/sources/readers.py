"""Declared-schema readers for CSV and Parquet layers.

* CSV is read with the declared schema (never inferred), header checked
  against it (``enforceSchema=false``: a reordered or renamed header raises
  instead of silently shifting data), PERMISSIVE mode with a corrupt-record
  column so malformed rows can be quarantined.
* Parquet layers are read as-is; the partitioned silver table gets partition
  discovery, so ``where(order_year=...)`` prunes directories.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from haulage.schemas import SOURCE_SPECS, SourceSpec

CORRUPT = "_corrupt_record"


def _spec(spec: SourceSpec | str) -> SourceSpec:
    if isinstance(spec, SourceSpec):
        return spec
    try:
        return SOURCE_SPECS[spec]
    except KeyError:
        raise ValueError(f"no schema defined for source {spec!r}") from None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Spark's own file listing (HDFS/S3 alike)."""
    try:
        spark.read.text(path).schema  # noqa: B018 - forces analysis (Spark Connect is lazy)
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return False
        raise
    return True


def require_paths(spark: SparkSession, paths: dict[str, str]) -> None:
    """Pre-flight: every named path must exist, else ``FileNotFoundError``."""
    missing = {n: p for n, p in paths.items() if not path_exists(spark, p)}
    if missing:
        raise FileNotFoundError(f"missing source files: {missing}")


def _csv_reader(spark: SparkSession, schema: StructType, null_value: str | None, enforce_header: bool):
    reader = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", "false" if enforce_header else "true")
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader


def read_source(
    spark: SparkSession,
    spec: SourceSpec | str,
    path: str | None = None,
    null_value: str | None = None,
    enforce_header: bool = True,
    base_dir: str = ".",
) -> DataFrame:
    """Read a CSV source with its declared schema (malformed fields -> NULL); without a path, from its default below ``base_dir``."""
    s = _spec(spec)
    p = path or s.default_path(base_dir)
    return _csv_reader(spark, s.schema, null_value, enforce_header).csv(p)


def read_source_quarantine(
    spark: SparkSession,
    spec: SourceSpec | str,
    path: str | None = None,
    null_value: str | None = None,
    base_dir: str = ".",
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of a CSV source.

    Rows that do not fit the schema (too few or too many fields, a value that
    does not parse as its type) keep their raw text in ``_corrupt_record``
    and go to the quarantine frame.  A filter that references only the
    corrupt-record column is rejected by Spark, so the split keeps the data
    columns in the projection.  Corruption is detected on the columns a query
    parses (Spark prunes CSV parsing), so count with ``count_quarantined``,
    which parses them all.
    """
    s = _spec(spec)
    p = path or s.default_path(base_dir)
    schema = StructType(list(s.schema.fields) + [StructField(CORRUPT, StringType(), True)])
    df = _csv_reader(spark, schema, null_value, True).csv(p)
    cols = [f.name for f in s.schema.fields]
    # A query that reads few columns parses few: a row counts as whole only if all its columns were parsed,
    # so the filter looks at every one of them (the comparison holds for every hash).
    whole = F.col(CORRUPT).isNull() & (F.xxhash64(*cols) >= F.lit(-(2**63)))
    good = df.filter(whole).select(*cols)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(*cols, CORRUPT)
    return good, bad


def count_quarantined(bad: DataFrame) -> int:
    """Number of quarantined rows.

    The CSV parser only parses the columns a query needs, and a row is only
    flagged corrupt when a parsed field fails, so the count references every
    data column (through a hash the optimizer cannot drop).  A bare
    ``count()`` would prune down to the corrupt-record column alone, which
    Spark rejects.
    """
    data_cols = [c for c in bad.columns if c != CORRUPT]
    row = bad.agg(F.count(F.lit(1)).alias("n"), F.max(F.xxhash64(*data_cols)).alias("_all")).collect()[0]
    return int(row["n"])


@dataclass
class Connection:
    """A checked source: rows that fit its schema, rows that do not, and the columns that hold unfitting values."""

    rows: DataFrame
    quarantine: DataFrame
    unfit: DataFrame  # per column: text values that are not of the declared type

    def warnings(self) -> list[str]:
        """One line per column with values of another type (a job; one row per column comes back)."""
        return [
            f"{r['column_name']}: {r['unfit_values']} values are not of type {r['data_type']}"
            for r in self.unfit.where("unfit_values > 0").orderBy("column_name").collect()
        ]


def unfit_values(text_rows: DataFrame, spec: SourceSpec | str) -> DataFrame:
    """Per typed column: values that are present as text but cannot be read as the declared type."""
    s = _spec(spec)
    typed = [f for f in s.schema.fields if not isinstance(f.dataType, StringType) and f.name in text_rows.columns]
    kind = "column_name string, data_type string, unfit_values bigint"
    if not typed:
        return text_rows.sparkSession.createDataFrame([], kind)
    agg = text_rows.agg(
        *[F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in typed]
    )
    names = F.create_map(*[x for f in typed for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    rows = agg.unpivot([], [f.name for f in typed], "column_name", "unfit_values")
    return rows.select("column_name", names[F.col("column_name")].alias("data_type"), "unfit_values")


def connect(
    spark: SparkSession,
    spec: SourceSpec | str,
    path: str | None = None,
    null_value: str | None = None,
    base_dir: str = ".",
) -> DataFrame:
    """Checked connection to a source: the rows that fit its schema (see ``connect_checked``)."""
    return connect_checked(spark, spec, path, null_value, base_dir).rows


def connect_checked(
    spark: SparkSession,
    spec: SourceSpec | str,
    path: str | None = None,
    null_value: str | None = None,
    base_dir: str = ".",
) -> Connection:
    """Checked connection to a source, by default at its registered place below ``base_dir``.

    Missing file -> ``FileNotFoundError``; header that lacks a required column
    -> ``ValueError``; otherwise a ``Connection``.  Malformed rows are in its
    quarantine and not among its rows.
    """
    from haulage.operators.contracts import validate_schema

    s = _spec(spec)
    p = path or s.default_path(base_dir)
    if not path_exists(spark, p):
        raise FileNotFoundError(f"source file does not exist: {p}")
    header = spark.read.option("header", "true").option("inferSchema", "false").csv(p)
    result = validate_schema(header, s)
    if not result.valid:
        raise ValueError(f"source {s.name!r} failed schema validation: {result.errors}")
    try:
        good, bad = read_source_quarantine(spark, s, p, null_value=null_value)
        good.schema  # noqa: B018 - resolve the relation now so header errors surface here
    except AnalysisException as e:  # pragma: no cover - header problems
        raise ValueError(f"source {s.name!r} could not be read: {e}") from e
    return Connection(good, bad, unfit_values(header, s))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet layer (bronze, silver, gold)."""
    return spark.read.parquet(path)


def read_gold_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Read a gold CSV export with its known schema (for report consumers)."""
    return spark.read.schema(schema).option("header", "true").csv(path)
