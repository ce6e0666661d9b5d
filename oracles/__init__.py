"""DuckDB SQL oracles: one shared CTE text for the panel and features."""
