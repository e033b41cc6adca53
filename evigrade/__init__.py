"""Grading of captured web pages and batch product requests on Spark DataFrames."""

from evigrade.config import Settings
from evigrade.engine import Batch, enrich_artifacts, grade, triage
from evigrade.functions.text import stable_id
from evigrade.functions.urls import slug
from evigrade.operators.batch import batch_summary, output_dir, requests_from_rows, result_rows

__version__ = "0.2.0"

__all__ = [
    "Batch",
    "Settings",
    "batch_summary",
    "enrich_artifacts",
    "grade",
    "output_dir",
    "requests_from_rows",
    "result_rows",
    "slug",
    "stable_id",
    "triage",
]
