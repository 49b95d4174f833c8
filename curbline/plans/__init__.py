from .graph import GraphError, Model, run_graph
from .lake import Lake
from .monthly import backfill, run_month

__all__ = ["GraphError", "Lake", "Model", "backfill", "run_graph", "run_month"]
