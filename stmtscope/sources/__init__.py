from stmtscope.sources.events import listed_files, load_stats, read_events
from stmtscope.sources.layout import cluster_facts
from stmtscope.sources.loads import DuplicateKeyError, Load, check_load, clashing_keys, loaded_files, unpublished_loads
from stmtscope.sources.tables import (
    TABLES,
    Version,
    append_batches,
    check_keys,
    create_tables,
    fact_loads,
    facts_of,
    new_load,
    stored_states,
    table_name,
    write_tables,
)

__all__ = [
    "DuplicateKeyError",
    "Load",
    "TABLES",
    "Version",
    "append_batches",
    "check_keys",
    "check_load",
    "clashing_keys",
    "cluster_facts",
    "create_tables",
    "fact_loads",
    "facts_of",
    "listed_files",
    "load_stats",
    "loaded_files",
    "new_load",
    "read_events",
    "stored_states",
    "table_name",
    "unpublished_loads",
    "write_tables",
]
