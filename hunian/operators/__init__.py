"""DataFrame operators: cleaning, key joins, facility counts, page records."""
