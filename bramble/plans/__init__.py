"""Named queries on the mapped tables, and their SQL oracles."""
