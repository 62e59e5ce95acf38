"""Marketplace order analytics on Spark: raw tables -> star schema -> reports."""

from feira.plans.etl import append_dimensions, append_etl, run_etl, run_etl_from_csv
from feira.plans.star import Star
from feira.session import build_session
from feira.sources.star_store import open_star

__all__ = [
    "Star",
    "append_dimensions",
    "append_etl",
    "build_session",
    "open_star",
    "run_etl",
    "run_etl_from_csv",
]
