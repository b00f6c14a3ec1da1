"""DataFrame operators: lookups, filters, routing, page parsing, duplicates, splits."""
