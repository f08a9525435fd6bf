"""Audit log: what was decided for each raw column of each dataset."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wavemeld.functions.names import safe_label
from wavemeld.operators.catalogue import further_columns
from wavemeld.operators.matching import MatchResult
from wavemeld.sources.scratch import scratch_dir
from wavemeld.sources.sinks import path_exists, write_by_dataset
from wavemeld.sources.staging import finish_runs, replaced_together

AUDIT_COLUMNS = ["dataset", "year", "raw_name", "canonical", "method", "confidence",
                 "needs_review", "action", "logged_at"]
MASTER_SCHEMA = ("year int, raw_name string, canonical string, method string, confidence string, "
                 "needs_review boolean, action string, logged_at string, dataset string")

# Action text per method, and review order of confidences.
ACTIONS = (("exact", "Renamed to canonical"), ("fuzzy", "Renamed — verify spelling"),
           ("keyword", "Predicted — must verify"), ("unmatched", "DROPPED — not in canonical set"))
ALREADY_CANONICAL = "Kept — already canonical"
CONFIDENCES = ("none", "low", "medium", "high")


def method_case(method: Column, cases: tuple[tuple[str, str], ...], default: str = "Unknown") -> Column:
    out = F.lit(default)
    for name, text in reversed(cases):
        hit = method.startswith("keyword") if name == "keyword" else method == name
        out = F.when(hit, F.lit(text)).otherwise(out)
    return out


def confidence_rank(confidence: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, CONFIDENCES)), confidence)


def add_unmatched(result: MatchResult) -> DataFrame:
    """Match log plus a row for every column nothing matched."""
    dropped = result.unmatched.select(
        "dataset", "ordinal", "raw_name", F.lit(None).cast("string").alias("canonical"),
        F.lit("unmatched").alias("method"), F.lit("none").alias("confidence"), F.lit(True).alias("needs_review"),
        *further_columns(result.unmatched))
    return result.log.unionByName(dropped)


def annotate(log: DataFrame, years: DataFrame | None = None, logged_at: str | None = None,
             canonical_names: list[str] | None = None) -> DataFrame:
    """Add year, action and time stamp; ``years`` has ``(dataset, year)``, if the log has no ``year``.

    ``canonical_names`` marks unmatched columns that stay because they already
    bear a canonical name.
    """
    action = method_case(F.col("method"), ACTIONS)
    if canonical_names:
        stays = (F.col("method") == "unmatched") & F.col("raw_name").isin(*canonical_names)
        action = F.when(stays, F.lit(ALREADY_CANONICAL)).otherwise(action)
    if years is not None:
        log = log.join(years.select("dataset", F.col("year").cast("int").alias("year")), "dataset", "left")
    elif "year" not in log.columns:
        log = log.withColumn("year", F.lit(None).cast("int"))
    stamp = logged_at or datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    return log.withColumns({"action": action, "logged_at": F.lit(stamp)})


def audit_order(extra: tuple[str, ...] = ("dataset", "ordinal")) -> list[Column]:
    """What needs review first, least confidence first, then log order."""
    return [F.col("needs_review").desc(), confidence_rank(F.col("confidence")), *map(F.col, extra)]


def sort_log(log: DataFrame) -> DataFrame:
    return log.orderBy(*audit_order())


def audit_log(result: MatchResult, years: DataFrame | None = None, logged_at: str | None = None,
              canonical_names: list[str] | None = None) -> DataFrame:
    """The audit rows of all datasets, in audit column order."""
    return annotate(add_unmatched(result), years, logged_at, canonical_names).select(*AUDIT_COLUMNS, "ordinal")


def stamp_issues(issues: DataFrame, years: DataFrame | None = None, logged_at: str | None = None) -> DataFrame:
    """Issue rows with year and time stamp."""
    if years is None:
        issues = issues.withColumn("year", F.lit(None).cast("int"))
    else:
        issues = issues.join(years.select("dataset", F.col("year").cast("int").alias("year")), "dataset", "left")
    return issues.withColumn("logged_at", F.lit(logged_at or datetime.now().strftime("%Y-%m-%d %H:%M:%S")))


def upsert(master: DataFrame, new: DataFrame, datasets: DataFrame | None = None) -> DataFrame:
    """Master log in which the datasets of ``new`` are replaced.

    ``datasets`` names them where a manifest does; otherwise ``new`` is computed for their names too.
    """
    fresh = (new if datasets is None else datasets).select("dataset").distinct()
    return master.join(fresh, "dataset", "left_anti").unionByName(new, allowMissingColumns=True)


def master_path(log_dir: str) -> str:
    return f"{log_dir}/match_log_MASTER"


def update_master_log(log: DataFrame, log_dir: str) -> None:
    """Replace the partitions of the datasets in ``log``; the others are not touched or read."""
    (log.select(*AUDIT_COLUMNS).hint("rebalance", "dataset").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(master_path(log_dir)))


def read_master_log(spark: SparkSession, log_dir: str) -> DataFrame:
    finish_runs(spark, log_dir)
    return spark.read.schema(MASTER_SCHEMA).parquet(master_path(log_dir)).select(*AUDIT_COLUMNS)


def export_match_log(result: MatchResult, log_dir: str, issues: DataFrame | None = None,
                     years: DataFrame | None = None, append_master: bool = True,
                     logged_at: str | None = None, canonical_names: list[str] | None = None) -> DataFrame:
    """Write the audit files of all datasets: one job per kind of file.

    ``match_log_<dataset>`` and ``issues_<dataset>`` are ``;``-separated, the
    master log is a table partitioned by dataset.  All are replaced together
    (see ``sources/staging.py``): a run that fails leaves the old files, and one
    that dies while they are moved is finished by the next export or reader.
    The columns are matched once; returns the audit rows.
    """
    logged_at = logged_at or datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    spark = result.log.sparkSession
    settled = scratch_dir(spark, "audit_log")
    log = audit_log(result, years, logged_at, canonical_names)
    log.write.parquet(settled)
    log = spark.read.schema(log.schema).parquet(settled)
    rank = confidence_rank(F.col("confidence"))
    with replaced_together(spark, log_dir) as place:
        write_by_dataset(log.withColumn("_rank", rank), place, F.concat(F.lit("match_log_"), safe_label("dataset")),
                         order=[F.col("needs_review").desc(), F.col("_rank"), F.col("ordinal")], columns=AUDIT_COLUMNS)
        if issues is not None:
            stamped = stamp_issues(issues, years, logged_at).withColumn("bad_values", F.to_json("bad_values"))
            write_by_dataset(stamped, place, F.concat(F.lit("issues_"), safe_label("dataset")),
                             order=[F.col("variable"), F.col("issue_type")], columns=stamped.columns)
        if append_master:
            update_master_log(log, place)
    return log


# -- summaries of the master log -----------------------------------------------------

@dataclass(frozen=True)
class MasterSummary:
    log: DataFrame
    by_method: DataFrame
    review_counts: DataFrame
    n_review: DataFrame
    predicted: DataFrame


def decisions_by_method(log: DataFrame) -> DataFrame:
    return log.groupBy("method").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "method")


def review_counts(log: DataFrame) -> DataFrame:
    return (log.filter("needs_review").groupBy("dataset", "year").agg(F.count("*").alias("n"))
            .orderBy("year", "dataset"))


def review_total(log: DataFrame) -> DataFrame:
    return log.agg(F.count_if("needs_review").alias("n_review"))


def predicted_matches(log: DataFrame) -> DataFrame:
    return (log.filter(F.col("method").startswith("keyword"))
            .select("dataset", "year", "raw_name", "canonical", "method"))


def summarise_master_log(spark: SparkSession, log_dir: str) -> MasterSummary | None:
    """Summary tables of the master log; None, with a note, if there is none."""
    finish_runs(spark, log_dir)
    if not path_exists(spark, master_path(log_dir)):
        print(f"No master log found at: {master_path(log_dir)}")
        return None
    log = read_master_log(spark, log_dir)
    return MasterSummary(log, decisions_by_method(log), review_counts(log), review_total(log), predicted_matches(log))
