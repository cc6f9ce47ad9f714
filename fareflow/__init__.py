"""Tabular regression on trip records, as Spark DataFrame and MLlib jobs."""

from fareflow.operators.features import clean_trips
from fareflow.operators.metrics import evaluation_record, regression_metrics
from fareflow.operators.model import fit_fares, load_model, predict, save_model
from fareflow.operators.runs import analysis_record, runs_by_config, run_totals
from fareflow.operators.split import hash_split
from fareflow.plans.evaluation import evaluate_cleaned
from fareflow.plans.preprocess import preprocess_months, preprocess_paths
from fareflow.plans.run_analysis import analyse_runs, read_analysis
from fareflow.plans.scoring import score, score_files, score_path
from fareflow.plans.training import train_on_cleaned, train_on_raw
from fareflow.sources.run_log import compact_run_log, read_run_log
from fareflow.sources.tables import read_submissions
from fareflow.streaming.intake import start_intake

__all__ = [
    "analyse_runs",
    "analysis_record",
    "clean_trips",
    "compact_run_log",
    "evaluate_cleaned",
    "evaluation_record",
    "fit_fares",
    "hash_split",
    "load_model",
    "predict",
    "preprocess_months",
    "preprocess_paths",
    "read_analysis",
    "read_run_log",
    "read_submissions",
    "regression_metrics",
    "run_totals",
    "runs_by_config",
    "save_model",
    "score",
    "score_files",
    "score_path",
    "start_intake",
    "train_on_cleaned",
    "train_on_raw",
]
