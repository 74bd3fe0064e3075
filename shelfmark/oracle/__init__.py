"""DuckDB SQL twins of the registered queries, written straight from the report definitions."""
