from .oracles import oracle_sql
from .queries import QUERIES

__all__ = ["QUERIES", "oracle_sql"]
