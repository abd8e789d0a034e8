"""DuckDB statements that state each query's expected result over the sample tables."""

from oracle.statements import oracle_statements

__all__ = ["oracle_statements"]
