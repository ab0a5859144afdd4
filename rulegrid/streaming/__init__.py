from rulegrid.streaming.rules_stream import rule_failure_counts, rules_stream, start_rules_to_parquet

__all__ = ["rule_failure_counts", "rules_stream", "start_rules_to_parquet"]
