"""Harmonise many yearly data files into one audited table, as Spark jobs."""

from wavemeld.operators.clean import CleanResult, clean_dataset
from wavemeld.operators.labels import apply_labels, make_codebook
from wavemeld.operators.matching import MatchResult, match_columns, match_report
from wavemeld.operators.merge import merge_datasets
from wavemeld.operators.summary import sum_up, summarise, summarize
from wavemeld.operators.validate import validate_dataset
from wavemeld.functions.encoding import fix_encode
from wavemeld.plans.audit import export_match_log, summarise_master_log
from wavemeld.plans.harmonise import run_pipeline
from wavemeld.plans.report import report_tables
from wavemeld.spec import Spec, load_config

codebook = make_codebook
print_match_report = match_report
render_report = report_tables

__all__ = [
    "CleanResult", "MatchResult", "Spec", "apply_labels", "clean_dataset",
    "codebook", "export_match_log", "fix_encode", "load_config",
    "make_codebook", "match_columns", "match_report", "merge_datasets",
    "print_match_report", "render_report", "report_tables", "run_pipeline",
    "sum_up", "summarise", "summarise_master_log", "summarize",
    "validate_dataset",
]
