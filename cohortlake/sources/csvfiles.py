"""CSV inputs with declared schemas, and CSV exports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.schemas import SCHEMAS, TABLES
from cohortlake.session import exists

CORRUPT = "_corrupt_record"
# Fixed value: the text form of timestamps in the input files.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
READ_FORMAT = "yyyy-MM-dd[ ]['T']HH:mm:ss[.SSSSSS]"


class MissingInputs(ValueError):
    """Some required input files do not exist."""

    def __init__(self, missing: list[str]):
        super().__init__("missing inputs: " + ", ".join(missing))
        self.missing = missing


def require(spark: SparkSession, paths: list[str]) -> None:
    """Raise :class:`MissingInputs` naming every path that is absent."""
    missing = [p for p in paths if not exists(spark, p)]
    if missing:
        raise MissingInputs(missing)


def read_csv(spark: SparkSession, path: str, table: str, keep_corrupt: bool = False) -> DataFrame:
    """One table with its declared schema; an empty field is NULL.

    Columns are taken by the names in the header, whatever their order; further
    ones are left out, a missing one is an error. Malformed rows become NULL fields.
    With ``keep_corrupt`` their text is kept in ``_corrupt_record``.
    """
    declared = SCHEMAS[table]
    header = spark.read.option("header", True).option("encoding", "UTF-8").csv(path).columns
    missing = [c for c in declared.names if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    schema = T.StructType(
        [declared[c] if c in declared.names else T.StructField(c, T.StringType()) for c in header]
    )
    kept = declared.names
    if keep_corrupt:
        schema.add(CORRUPT, T.StringType(), True)
        kept = [*kept, CORRUPT]
    read = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("timestampNTZFormat", READ_FORMAT)
        .option("encoding", "UTF-8")
        .csv(path)
    )
    return read.select(*kept)


def malformed_rows(spark: SparkSession, path: str, table: str) -> int:
    """Rows of a file with a field that does not fit its declared type."""
    rows = read_csv(spark, path, table, keep_corrupt=True)
    bad = F.coalesce(F.sum(F.col(CORRUPT).isNotNull().cast("int")), F.lit(0)).alias("bad")
    # Every column takes part, so that none is left unread.
    every = F.bit_xor(F.hash(*SCHEMAS[table].names)).alias("every")
    return rows.agg(bad, every).first()["bad"]


def read_csv_layer(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six tables of a folder of ``<table>.csv`` files, all required."""
    paths = {t: f"{folder.rstrip('/')}/{t}.csv" for t in TABLES}
    require(spark, list(paths.values()))
    return {t: read_csv(spark, p, t) for t, p in paths.items()}


def coerce_timestamps(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns to zone-less timestamps, unparsable text to NULL; others untouched."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    parsed = {c: F.col(c).try_cast("timestamp_ntz") for c in columns if c in text}
    return df.withColumns(parsed) if parsed else df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Header and values, timestamps in the input format."""
    df.write.mode(mode).option("header", True).option(
        "timestampNTZFormat", TIMESTAMP_FORMAT
    ).csv(path)


def read_export(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exported file with the schema it was written from; an empty field is NULL."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    return reader.option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path)
