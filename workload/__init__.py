"""Every operator run over the shared test tables, with its DuckDB counterpart."""
