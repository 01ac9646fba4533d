"""Named jobs (the eight analyses and their variants) and their DuckDB oracles."""
