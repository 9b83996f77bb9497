from kinroll.sources.tables import (
    CASES_RELATIONS,
    TABLES,
    cases_fixture,
    family_route,
    family_shards,
    join_field_rows,
    mixed_table,
    read_table,
    write_co_located,
)

__all__ = [
    "CASES_RELATIONS", "TABLES", "cases_fixture", "family_route", "family_shards", "join_field_rows",
    "mixed_table", "read_table", "write_co_located",
]
