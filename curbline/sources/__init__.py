from .catalog import model, named_source, register_view
from .files import read_gold_for_load, read_month, read_raw, read_table, read_zone_lookup

__all__ = [
    "model", "named_source", "read_gold_for_load", "read_month", "read_raw", "read_table",
    "read_zone_lookup", "register_view",
]
