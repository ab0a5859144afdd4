from rulegrid.sources.mapping import contexts, dynamic_contexts, key_list, table_a, table_b
from rulegrid.sources.tables import TABLES, read_table, table_path

__all__ = ["TABLES", "contexts", "dynamic_contexts", "key_list", "read_table", "table_a", "table_b", "table_path"]
