"""Batch data quality and revenue pipeline on Spark DataFrames."""

from tidemark.plans.batch import RunResult, run_pipeline
from tidemark.sources.contracts import DataContractError

__all__ = ["DataContractError", "RunResult", "run_pipeline"]
