"""Reading landing files: CSV feeds, JSON and Parquet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orelake.operators.history import as_ntz
from orelake.operators.ranking import sequence_ids
from orelake.schemas import CAMPAIGNS_FEED, STORES_FEED, TARGETS_FEED, Feed
from orelake.vocab import CSV_NULL_TOKENS, FEED_DATE_FORMAT

# Fixed values of the CSV format: comma, one header row, optional double quotes,
# trimmed fields, short and long rows tolerated.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "enforceSchema": "true",
    "mode": "PERMISSIVE",
}


def raw_schema(schema: T.StructType) -> T.StructType:
    """Every column as text, in file order."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def blank_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """The feed's null tokens become NULL."""

    def cleaned(name: str) -> Column:
        text = F.trim(F.col(name))
        return F.when(~text.isin(CSV_NULL_TOKENS), text)

    return df.withColumns({c: cleaned(c) for c in columns})


def read_csv_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All-text rows of a CSV feed plus the file each came from."""
    raw = spark.read.schema(raw_schema(schema)).options(**CSV_OPTIONS).csv(path)
    return blank_nulls(raw.withColumn("SOURCE_FILE", F.col("_metadata.file_path")), schema.fieldNames())


def read_json_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON files holding one array of objects (or one object) each; nulls are kept."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def _typed(f: T.StructField) -> tuple[Column, Column]:
    """(typed value, whether the field spoils its row). Dates are lenient, the rest strict."""
    text = F.col(f.name)
    if isinstance(f.dataType, T.DateType):
        value, wrong = F.to_date(F.try_to_timestamp(text, F.lit(FEED_DATE_FORMAT))), F.lit(False)
    elif isinstance(f.dataType, T.StringType):
        value, wrong = text, F.lit(False)
    else:
        value = text.try_cast(f.dataType)
        wrong = text.isNotNull() & value.isNull()
    if not f.nullable:
        wrong = wrong | text.isNull()
    return value, wrong


def typed_rows(raw: DataFrame, feed: Feed, loaded_at: datetime | str | None = None) -> DataFrame:
    """Typed rows of a feed with LOADED_AT, SOURCE_FILE and REJECTED, which is
    true where a strict value does not parse or a required one is missing."""
    fields = [(f.name, *_typed(f)) for f in feed.schema.fields]
    rejected = F.lit(False)
    for _, _, wrong in fields:
        rejected = rejected | wrong
    moment = as_ntz(loaded_at if loaded_at is not None else F.current_timestamp())
    return raw.select(
        *[v.alias(n) for n, v, _ in fields],
        moment.alias("LOADED_AT"),
        "SOURCE_FILE",
        rejected.alias("REJECTED"),
    )


def load_feed(spark: SparkSession, path: str, feed: Feed, loaded_at=None) -> DataFrame:
    rows = typed_rows(read_csv_feed(spark, path, feed.schema), feed, loaded_at)
    return rows.filter(~F.col("REJECTED")).drop("REJECTED")


def load_targets(spark: SparkSession, path: str, loaded_at=None, first_id: int = 1) -> DataFrame:
    rows = load_feed(spark, path, TARGETS_FEED, loaded_at)
    ids = sequence_ids(rows, [c for c in rows.columns if c != "LOADED_AT"], "TARGET_ID", first_id)
    return ids.select("TARGET_ID", *rows.columns)


def load_campaigns(spark: SparkSession, path: str, loaded_at=None) -> DataFrame:
    return load_feed(spark, path, CAMPAIGNS_FEED, loaded_at)


def load_stores(spark: SparkSession, path: str, loaded_at=None) -> DataFrame:
    return load_feed(spark, path, STORES_FEED, loaded_at)


def load_log(rows: DataFrame, table: str) -> DataFrame:
    """Per-file counts of typed rows, in the form kept in the load log."""
    return rows.groupBy("SOURCE_FILE").agg(
        F.lit(table).alias("TABLE_NAME"),
        F.count_if(~F.col("REJECTED")).alias("ROW_COUNT"),
        F.count_if(F.col("REJECTED")).alias("ERROR_COUNT"),
        F.max("LOADED_AT").alias("LAST_LOAD_TIME"),
    )


def load_history(log: DataFrame, since: datetime | str | None = None) -> DataFrame:
    """Per table and file: status, rows loaded, rows rejected, last load; newest first."""
    if since is not None:
        log = log.filter(F.col("LAST_LOAD_TIME") >= as_ntz(since))
    status = (
        F.when(F.col("ERROR_COUNT") == 0, "LOADED")
        .when(F.col("ROW_COUNT") > 0, "PARTIALLY_LOADED")
        .otherwise("LOAD_FAILED")
    )
    return (
        log.groupBy("TABLE_NAME", F.col("SOURCE_FILE").alias("FILE_NAME"))
        .agg(
            F.sum("ROW_COUNT").alias("ROW_COUNT"),
            F.sum("ERROR_COUNT").alias("ERROR_COUNT"),
            F.max("LAST_LOAD_TIME").alias("LAST_LOAD_TIME"),
        )
        .select("TABLE_NAME", "FILE_NAME", status.alias("STATUS"), "ROW_COUNT", "ERROR_COUNT", "LAST_LOAD_TIME")
        .orderBy(F.col("LAST_LOAD_TIME").desc(), "TABLE_NAME", "FILE_NAME")
    )
