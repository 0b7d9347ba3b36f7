from evenframe.sources.delimited import (
    BAR_DOLLAR,
    COMMA,
    RECORD_SEPARATOR,
    TAB,
    read_delimited,
)
from evenframe.sources.dictionary import (
    CRM_SCHEMA,
    ERP_SCHEMA,
    STAGING_SCHEMA,
    load_dictionary,
    read_dictionary,
    source_table,
)
from evenframe.sources.paths import resolve_paths, table_mode
from evenframe.sources.relational import jdbc_options, read_jdbc
from evenframe.sources.sinks import (
    write_delimited,
    write_profile,
    write_report,
    write_staged,
    write_text,
)

__all__ = [
    "BAR_DOLLAR", "COMMA", "RECORD_SEPARATOR", "TAB", "read_delimited",
    "CRM_SCHEMA", "ERP_SCHEMA", "STAGING_SCHEMA",
    "load_dictionary", "read_dictionary", "source_table",
    "resolve_paths", "table_mode",
    "jdbc_options", "read_jdbc",
    "write_delimited", "write_profile", "write_report", "write_staged", "write_text",
]
