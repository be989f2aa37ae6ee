"""Secrets in every historical version of a file, each content scanned once per rule version."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mrrlens.llm.storage import SHUFFLE_CLEANUP
from mrrlens.session import session_settings


class Rule(NamedTuple):
    """A kind of secret: matches count if the group has at least so many characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int


# Fixed patterns, in the order in which kinds are listed.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    # Shorter runs would be dropped; asking for the length at once spares a match in every word.
    Rule("hex", 1, "[0-9a-f]{24,}", 0, 24),
)
#: Matches whose places are added up one after the other.
RUN = 512
SPAN = "struct<kind: string, start: bigint, end: bigint>"
LEDGER = "blob string, kind string, version int, spans array<struct<start: bigint, end: bigint>>"


def spans_of(text: Column, rule: Rule) -> Column:
    """Where a rule's matches lie, leftmost first, in code points, end exclusive.

    The text between matches comes from splitting at them, so places are sums of
    lengths. They are summed in runs, so that many matches stay linear.
    """
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    keys = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else hits
    sizes = F.zip_with(
        F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda hit, gap: F.struct(
            F.char_length(gap).cast("long").alias("gap"), F.char_length(hit).cast("long").alias("hit"),
        )),
        keys,
        lambda one, key: F.struct(one["gap"].alias("gap"), one["hit"].alias("hit"), F.char_length(key).alias("key")),
    )
    zero = F.lit(0).cast("long")
    empty = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def in_runs(sizes: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / RUN).cast("int"))
        return F.transform(numbers, lambda number: F.slice(sizes, number * RUN + 1, RUN))

    def length(run: Column) -> Column:
        return F.aggregate(run, zero, lambda total, one: total + one["gap"] + one["hit"])

    def step(state: Column, one: Column) -> Column:
        start = state["at"] + one["gap"]
        end = start + one["hit"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        found = F.when(one["key"] >= rule.least, F.concat(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def places(runs: Column) -> Column:
        before = F.transform(runs, length)
        return F.flatten(F.transform(runs, lambda run, number: F.aggregate(
            run,
            F.struct(
                F.aggregate(F.slice(before, 1, number), zero, lambda a, b: a + b).alias("at"),
                empty.alias("found"),
            ),
            step,
        )["found"]))

    # Each step's array is bound once; as plain expressions they would be computed anew for each element.
    def bound(value: Column, use) -> Column:
        return F.element_at(F.transform(F.array(value), use), 1)

    spans = bound(sizes, lambda own: bound(in_runs(own), places))
    return F.when(F.regexp_like(text, pattern), spans).otherwise(empty)


def addressed(versions: DataFrame, text_column: str) -> DataFrame:
    """All rows of the versions as one column, with the text and its address (null texts are empty)."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return versions.select(F.struct("*").alias("version"), F.sha2(text, 256).alias("blob"), text.alias("text"))


class SecretLedger:
    """What has been scanned and found, by content and rule version, in a folder of its own.

    Each run adds a row for each pair of a content and a rule version that it was
    first to scan, with or without findings. A run that dies before its write is
    committed adds nothing; pairs that two runs both added count once.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def known(self) -> DataFrame | None:
        try:
            rows = self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return rows.dropDuplicates(["blob", "kind", "version"])

    def unseen(self, versions: DataFrame, rules: tuple[Rule, ...], text_column: str) -> DataFrame:
        """Contents that some rule version has not scanned, once each, and what scanned them."""
        blobs = addressed(versions, text_column).select("blob", "text")
        known = self.known()
        wanted = [F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version")) for rule in rules]
        none = F.array().cast("array<struct<kind: string, version: int>>")
        if known is None:
            return blobs.dropDuplicates(["blob"]).withColumn("seen", none)
        seen = known.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
        left = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", none))
        return left.where(F.size(F.array_except(F.array(*wanted), "seen")) > 0).dropDuplicates(["blob"])

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> None:
        """Scan what is new in the versions, whole texts, and add it to the ledger."""
        pairs = []
        for rule in rules:
            mark = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))
            spans = F.when(~F.array_contains("seen", mark), spans_of(F.col("text"), rule))
            pairs.append(F.struct(mark["kind"].alias("kind"), mark["version"].alias("version"), spans.alias("spans")))
        scanned = self.unseen(versions, rules, text_column).select("blob", F.array(*pairs).alias("pairs"))
        rows = scanned.select("blob", F.inline("pairs")).where(F.col("spans").isNotNull())
        with session_settings(self.spark, {SHUFFLE_CLEANUP: "true"}):
            rows.write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
        """All rows and columns of the versions, with `secrets` as the last: the spans that the rules
        have found in the content, by start and order of the rules. A column of that name is replaced."""
        none = F.array().cast(f"array<{SPAN}>")
        keyed = addressed(versions, text_column).drop("text")
        others = [F.col(f"version.`{name}`") for name in versions.columns if name.lower() != "secrets"]
        known = self.known()
        if known is None:
            return keyed.select(*others, none.alias("secrets"))
        order = F.create_map(*[F.lit(item) for n, rule in enumerate(rules) for item in (f"{rule.kind} {rule.version}", n)])
        own = known.withColumn("order", order[F.concat_ws(" ", "kind", "version")])
        found = own.where(F.col("order").isNotNull() & (F.size("spans") > 0))
        each = F.transform("spans", lambda span: F.struct(span["start"], F.col("order"), span["end"], F.col("kind")))
        by_blob = found.groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(each))).alias("spans"))
        secrets = F.transform("spans", lambda span: F.struct(
            span["kind"].alias("kind"), span["start"].alias("start"), span["end"].alias("end")
        ))
        return keyed.join(by_blob.select("blob", secrets.alias("found")), "blob", "left").select(
            *others, F.coalesce("found", none).alias("secrets")
        )


def scan_secrets(
    versions: DataFrame, ledger: SecretLedger, rules: tuple[Rule, ...] = RULES, text_column: str = "text"
) -> DataFrame:
    """Scan all versions of files through the ledger; every row with its secrets.

    Contents are known by their sha256, so a content is scanned once per version
    of a rule, however many paths, commits, copies or runs have it. Null texts are
    empty texts and have no secrets; repeated rows each get the findings; an empty
    table gives an empty one. A column named `secrets` is replaced; all others pass.
    """
    ledger.scan(versions, rules, text_column)
    return ledger.findings(versions, rules, text_column)
