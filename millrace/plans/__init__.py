"""Staging views and marts, each a function from DataFrames to a DataFrame."""

from millrace.plans.build import build_marts
from millrace.plans.flow import run_flow
from millrace.plans.marts import dim_customers, fct_orders, metrics_daily
from millrace.plans.staging import stg_customers, stg_orders, stg_payments

__all__ = [
    "build_marts",
    "dim_customers",
    "fct_orders",
    "metrics_daily",
    "run_flow",
    "stg_customers",
    "stg_orders",
    "stg_payments",
]
