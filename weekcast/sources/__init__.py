"""Sources and sinks: driver tables, the derived demand panel, files."""
