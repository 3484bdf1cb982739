"""Table operators: joins, aggregates, ranks, rules, set operations, reconciliation, checks."""
