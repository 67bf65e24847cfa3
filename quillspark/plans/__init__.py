"""Registered end-to-end queries over the test tables, each with its DuckDB
oracle SQL where one exists (see ``registry.load_all``)."""
