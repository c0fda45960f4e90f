"""Readers and writers. Every writer uses Spark's own file formats and committers."""

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata import schema
from clickstrata.sources.scratch import clear_scratch, scratch_path

# Where each table of the lake sits below its root.
LAYERS = {
    "bronze_events": "bronze/events",
    "fact_events": "silver/fact_events",
    "fact_sessions": "silver/fact_sessions",
    "product_daily": "gold/product_daily",
    "user_daily": "gold/user_daily",
    "funnel_daily": "gold/funnel_daily",
    "mart_cohort_weekly_retention": "gold/mart_cohort_weekly_retention",
    "mart_session_funnel_daily": "gold/mart_session_funnel_daily",
    "mart_experiment_readout": "gold/mart_experiment_readout",
    "experiment_readout_enhanced": "gold/experiment_readout_enhanced",
    "ml_session_dataset": "gold/ml_session_dataset",
    "ml_session_scores": "gold/ml_session_scores",
    "ml_pr_curve": "gold/ml_pr_curve",
    "ml_roc_curve": "gold/ml_roc_curve",
}
VIEWS = ("fact_events", "fact_sessions", "funnel_daily", "user_daily", "product_daily")
GOLD_TABLES = ("product_daily", "user_daily", "funnel_daily")


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """The raw feed from a CSV file or folder with header lines; nothing is inferred."""
    return spark.read.schema(schema.RAW_EVENTS).option("header", True).csv(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table stored as ``<folder>/<name>.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_nested(spark: SparkSession, *paths: str) -> DataFrame:
    """All Parquet files in any folder below the paths, whatever the folders are called.

    Columns that only some files have are NULL in the others. Folder names give no columns here;
    :func:`read_layer` reads the layers' own year and month folders.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    return reader.parquet(*paths)


def layer_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{LAYERS[name]}"


def read_layer(
    spark: SparkSession, root: str, name: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """A stored layer; ``year`` and ``month`` come back from the folder names.

    ``since`` and ``until`` (both inclusive) limit the rows by their event or
    session date. The same bounds on year and month keep other folders unread.
    """
    df = spark.read.parquet(layer_path(root, name))
    day = F.col("session_date" if "session_date" in df.columns else "event_date")
    month = F.col("year") * 12 + F.col("month")
    if since:
        df = df.where(day >= F.lit(since)).where(month >= since.year * 12 + since.month)
    if until:
        df = df.where(day <= F.lit(until)).where(month <= until.year * 12 + until.month)
    return df


def month_number(day: date) -> int:
    """Months are counted from year 0, so that a span of months is a span of numbers."""
    return day.year * 12 + day.month


def in_months(months: Iterable[int]) -> Column:
    """Whether a row's year and month are among the numbered months. Only columns of folder names are used, so others stay unread."""
    return (F.col("year") * 12 + F.col("month")).isin(*sorted(set(months)))


def layer_exists(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a layer has been written."""
    path, file_system = _hadoop_path(spark, layer_path(root, name))
    return file_system.exists(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_months(df: DataFrame, root: str, name: str, months: Iterable[int], rebalance: bool | int = True) -> list[int]:
    """Makes ``df``, whose rows lie in the given months, all that a layer holds of these months. Returns those left empty.

    ``df`` may read the layer itself: it is stored aside first. Months of ``df`` are overwritten by Spark's
    dynamic partition overwrite; folders of months that have no rows any more are deleted after that.
    """
    spark = df.sparkSession
    aside = scratch_path(spark, name)
    df.write.parquet(aside)
    rows = spark.read.schema(df.schema).parquet(aside)
    filled = {r["year"] * 12 + r["month"] for r in rows.select("year", "month").distinct().collect()}
    if filled:
        write_layer(rows, layer_path(root, name), rebalance=rebalance)
    empty = sorted(set(months) - filled)
    for month in empty:
        year, of_year = divmod(month - 1, 12)
        path, file_system = _hadoop_path(spark, f"{layer_path(root, name)}/year={year}/month={of_year + 1}")
        file_system.delete(path, True)
    clear_scratch(spark, aside)
    return empty


def register_views(spark: SparkSession, root: str, names: Iterable[str] = VIEWS) -> dict[str, DataFrame]:
    """Temp views over the stored layers, for ``spark.sql`` users."""
    tables = {name: read_layer(spark, root, name) for name in names}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("year", "month"),
    *,
    dynamic: bool = True,
    rebalance: bool | int = False,
    coalesce: int | None = None,
) -> None:
    """Overwrite a partitioned Parquet layer.

    With ``dynamic`` only the partitions present in ``df`` are replaced, so a
    rerun of one month leaves the other months alone. ``rebalance`` lets
    adaptive execution gather each partition's rows into files near the
    advisory size and cut a partition that holds most of the rows into several
    tasks (an integer asks for that many shuffle partitions); a plain
    repartition on year and month would put a whole month into one task.
    """
    if coalesce:
        df = df.coalesce(coalesce)
    elif rebalance is not False:
        numbers = [] if rebalance is True else [int(rebalance)]
        df = df.hint("rebalance", *numbers, *partition_by)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def build_mart(spark: SparkSession, name: str, df: DataFrame, path: str) -> DataFrame:
    """Store a mart as a ZSTD Parquet table, register it as a temp view and hand it back."""
    export_parquet(df, path)
    mart = spark.read.schema(df.schema).parquet(path)
    mart.createOrReplaceTempView(name)
    return mart


def export_parquet(df: DataFrame, path: str) -> None:
    """ZSTD-compressed Parquet export."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report (one row, or a few) as a single JSON file."""
    # A shuffle, so that the work before it keeps its tasks.
    df.repartition(1).write.mode("overwrite").json(path)


def describe(df: DataFrame) -> DataFrame:
    """Column names and types, one row per column."""
    rows = [(field.name, field.dataType.simpleString()) for field in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def layer_manifest(spark: SparkSession, root: str, names: Iterable[str] = GOLD_TABLES) -> DataFrame:
    """Table name to path, one row per table."""
    rows = [(name, layer_path(root, name)) for name in names]
    return spark.createDataFrame(rows, "table_name string, path string")
