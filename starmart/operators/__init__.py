"""Table-to-table building blocks: lookups, keyed merges, ids, dimensions, facts, checks, sinks."""
