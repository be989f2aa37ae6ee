"""The five raw extracts and how to read them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns each extract carries. All of them land as text.
RAW_COLUMNS = {
    "accounts": (
        "account_id", "account_name", "industry", "country", "signup_date",
        "referral_source", "plan_tier", "seats", "is_trial", "churn_flag",
    ),
    "subscriptions": (
        "subscription_id", "account_id", "start_date", "end_date", "plan_tier",
        "seats", "mrr_amount", "arr_amount", "is_trial", "upgrade_flag",
        "downgrade_flag", "churn_flag", "billing_frequency", "auto_renew_flag",
    ),
    "feature_usage": (
        "usage_id", "subscription_id", "usage_date", "feature_name", "usage_count",
        "usage_duration_secs", "error_count", "is_beta_feature",
    ),
    "support_tickets": (
        "ticket_id", "account_id", "submitted_at", "closed_at",
        "resolution_time_hours", "priority", "first_response_time_minutes",
        "satisfaction_score", "escalation_flag",
    ),
    "churn_events": (
        "churn_event_id", "account_id", "churn_date", "reason_code",
        "refund_amount_usd", "preceding_upgrade_flag", "preceding_downgrade_flag",
        "is_reactivation", "feedback_text",
    ),
}


class RawTables:
    """The extracts by name. `read` gives one; it is called when a table is first used."""

    def __init__(self, read: Callable[[str], DataFrame]) -> None:
        self._read = read
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]


def text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])


# Extracts with free text, in which a quoted value may hold line breaks. Their lines are brought
# together by block of the file, which costs a shuffle.
FREE_TEXT = ("churn_events",)
BAD_RECORD = "_bad_record"
# Quotes within a value are doubled.
CSV_QUOTES = {"header": True, "quote": '"', "escape": '"'}
#: What a record of several lines must look like: values in quotes, or without any.
VALUE = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",\n]*+)'
RECORD = rf"^{VALUE}(?:,{VALUE})*+\r?$"


def read_csv(spark: SparkSession, table: str, path: str, free_text: tuple[str, ...]) -> DataFrame:
    """One extract from CSV, all columns as text.

    Records with too few or too many values fail the query instead of being
    filled up or cut. Only whole records show that, so none is read in part.
    """
    schema = text_schema(table).add(BAD_RECORD, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    if table in free_text:
        quotes = {name: value for name, value in CSV_QUOTES.items() if name != "header"}
        parsed = F.from_csv("record", schema.toDDL(), {**quotes, **options})
        rows, hint = whole_records(spark, table, path).select(parsed.alias("row")).select("row.*"), ""
    else:
        reader = spark.read.schema(schema).options(**CSV_QUOTES, **options, enforceSchema=False, columnPruning=False)
        rows, hint = reader.csv(path), f" (if values hold line breaks, name {table} in free_text)"
    failed = F.raise_error(F.concat(F.lit(f"{table}: record of the wrong width{hint}: "), F.col(BAD_RECORD)))
    return rows.where(F.when(F.col(BAD_RECORD).isNull(), True).otherwise(failed.cast("boolean")))


def whole_records(spark: SparkSession, table: str, path: str) -> DataFrame:
    """`record`: the records of CSV files whose quoted values may hold line breaks, without the header.

    A line break ends a record if the quotes before it in the file are even in number.
    Each block of a file is counted by a task of its own; a running sum over blocks, of
    which a file has few, tells whether a block begins inside quotes, another numbers
    the records that have several lines. So one large file is read by as many tasks as
    it has blocks. Lines that are a record by themselves are not grouped.
    """
    quotes = (F.length("value") - F.length(F.translate("value", '"', ""))) % 2
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value", quotes.alias("odd"),
    )
    earlier_blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("file", "block").orderBy("line")
    above = in_block.rowsBetween(Window.unboundedPreceding, -1)

    def before(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    blocks = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("odd"))
    blocks = blocks.select("file", "block", before("odd", earlier_blocks).alias("before_block"))
    placed = lines.join(blocks, ["file", "block"]).select(
        "file", "block", "line", "value", "odd", ((F.col("before_block") + before("odd", above)) % 2).alias("inside"),
        ((F.col("block") == 0) & (F.row_number().over(in_block) == 1)).alias("is_header"),
    )
    names = F.regexp_replace(F.col("value"), "[\"\r\ufeff]", "")
    wrong = F.raise_error(F.concat(F.lit(f"{table}: not the columns of this extract: "), F.col("value")))
    header = F.when(F.lower(names) == ",".join(RAW_COLUMNS[table]), False).otherwise(wrong.cast("boolean"))
    placed = placed.where(F.when(F.col("is_header"), header).otherwise(True))

    alone = (F.col("inside") == 0) & (F.col("odd") == 0)
    single = placed.where(alone & (F.trim(F.regexp_replace("value", "\r", "")) != "")).select("value")
    parts = placed.where(~alone).withColumn("opens", (F.col("inside") == 0).cast("int"))
    parts = parts.withColumn("opened", F.sum("opens").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    opened = parts.groupBy("file", "block").agg(F.sum("opens").alias("opens"))
    opened = opened.select("file", "block", before("opens", earlier_blocks).alias("first"))
    numbered = parts.join(opened, ["file", "block"]).withColumn("number", F.col("first") + F.col("opened"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    joined = numbered.groupBy("file", "number").agg(F.array_join(F.transform(pieces, lambda one: one["value"]), "\n").alias("value"))
    stray = F.raise_error(F.concat(F.lit(f"{table}: a quote in a value without quotes, or none at its end: "), F.col("value")))
    joined = joined.where(F.when(F.regexp_like("value", F.lit(RECORD)), True).otherwise(stray.cast("boolean")))
    return single.unionByName(joined.select("value")).select(F.regexp_replace("value", "\r$", "").alias("record"))


def read_raw(
    spark: SparkSession, table: str, path: str, file_format: str = "csv", free_text: tuple[str, ...] = FREE_TEXT
) -> DataFrame:
    """One extract, without a pass for inference."""
    if file_format == "csv":
        rows = read_csv(spark, table, path, free_text)
    else:
        rows = spark.read.format(file_format).load(path)
    return rows.select(*RAW_COLUMNS[table])


def read_raw_tables(
    spark: SparkSession, root: str, file_format: str = "csv", free_text: tuple[str, ...] = FREE_TEXT
) -> RawTables:
    """All five extracts, each at `<root>/<table>` (a folder or file of that format).

    `free_text` names the CSV extracts whose values may hold line breaks.
    """
    return RawTables(lambda name: read_raw(spark, name, f"{root}/{name}", file_format, free_text))


def land_raw_tables(
    raw: RawTables, root: str, file_format: str = "parquet", names: Iterable[str] = tuple(RAW_COLUMNS)
) -> None:
    """Write extracts under `root`, where `read_raw_tables` finds them."""
    for name in names:
        writer = raw.table(name).write.mode("errorifexists").format(file_format)
        if file_format == "csv":
            # Spaces around a value are the parsers' business, not the file's.
            writer = (
                writer.options(**CSV_QUOTES)
                .option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False)
            )
        writer.save(f"{root}/{name}")
