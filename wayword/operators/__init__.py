"""DataFrame operators: joins, aggregations and loops."""
