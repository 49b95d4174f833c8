from .contract import ContractError, contract_violation, decode_json, require_schema, split_contract
from .landing import dead_letters, landed, landed_events, late_counts, read_landed_events, start_landing
from .sink import drained, start_file_sink
from .source import kafka_values, read_event_files, read_json_lines, write_in_slices
from .speed import fare_anomaly_stream, hop_average_stream, once_per_trip, start_speed_layer, zone_demand_stream

__all__ = [
    "ContractError", "contract_violation", "dead_letters", "decode_json", "drained", "fare_anomaly_stream",
    "hop_average_stream", "kafka_values", "landed", "landed_events", "late_counts", "once_per_trip", "read_event_files",
    "read_json_lines", "read_landed_events", "require_schema", "split_contract", "start_file_sink", "start_landing",
    "start_speed_layer", "write_in_slices", "zone_demand_stream",
]
