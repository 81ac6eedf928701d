"""Bronze: load a raw campaign CSV verbatim.

Every column stays text (no inference), columns are picked by header name (extra
columns are ignored, missing ones fail), malformed rows fail the job, and each
row is stamped with the load instant and the source it came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendstar.schemas import RAW_COLUMNS
from spendstar.sources.quoted import read_records

# URI schemes that need credentials configured on the Hadoop side.
_OBJECT_STORE_PREFIXES = ("abfs://", "abfss://", "az://", "wasb://", "wasbs://", "s3://", "s3a://", "gs://")


# How cells are read: text as it is, malformed rows fail.
CELLS = {
    "escape": '"',
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def check_credentials(spark: SparkSession, uri: str, required_conf: str | None) -> None:
    """Fail early when an object-store URI is read without its credential setting."""
    if not uri.startswith(_OBJECT_STORE_PREFIXES) or required_conf is None:
        return
    hconf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    if not (hconf.get(required_conf) or spark.conf.get(required_conf, None)):
        raise ValueError(f"reading {uri} needs the Hadoop setting {required_conf}")


def read_raw_csv(
    spark: SparkSession,
    uri: str,
    *,
    multiline: bool = False,
    credential_conf: str | None = None,
    with_file_path: bool = False,
    all_columns: bool = False,
) -> DataFrame:
    """Read raw campaign events (header row, all text) from a file, folder or glob.

    ``multiline`` allows quoted cells with line breaks. Files are split all the same (see
    ``quoted``), but read twice, so it is off by default. ``credential_conf`` names the Hadoop setting an
    object-store URI needs (for example an account key); it is checked up front.
    ``all_columns`` keeps columns beyond the known ones. ``with_file_path`` adds ``_source_file``: the file each row was read from.
    """
    check_credentials(spark, uri, credential_conf)
    # A FAILFAST scan that prunes columns silently accepts ragged rows.
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    df = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .options(**CELLS)
        .csv(uri)
    )
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"raw file {uri} lacks columns {missing}; header is {df.columns}")
    wanted = df.columns if all_columns else RAW_COLUMNS
    cols = [F.col(f"`{c}`").cast("string").alias(c) for c in wanted]
    if multiline:
        df = _parsed_records(spark, uri, df.schema)
        file_path = F.col("__file")
    else:
        file_path = F.col("_metadata.file_path")
    if with_file_path:
        cols.append(file_path.alias("_source_file"))
    return df.select(*cols)


def _parsed_records(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    """Cells of all records but each file's header, and ``__file``."""
    records = read_records(spark, [uri]).where(~F.col("first"))
    names = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema))])
    cells = F.from_csv("record", names.toDDL(), CELLS)
    # the generator keeps the record from being parsed once a column
    parsed = records.select(F.col("file").alias("__file"), F.inline(F.array(cells)))
    return parsed.select("__file", *[F.col(f"c{k}").alias(f.name) for k, f in enumerate(schema)])


def to_bronze(raw: DataFrame, source: str | None = None) -> DataFrame:
    """Stamp raw rows with the load instant and their source.

    ``source`` is the path as given; without it the ``_source_file`` column that
    ``read_raw_csv(..., with_file_path=True)`` adds is kept (multi-file loads).
    """
    src = F.lit(source) if source is not None else F.col("_source_file")
    return raw.select(
        *RAW_COLUMNS,
        F.current_timestamp().alias("_ingested_at"),
        src.cast("string").alias("_source_file"),
    )


def load_bronze(spark: SparkSession, uri: str, **kwargs) -> DataFrame:
    """``read_raw_csv`` + lineage stamp: the bronze layer as a DataFrame."""
    return to_bronze(read_raw_csv(spark, uri, **kwargs), source=uri)
