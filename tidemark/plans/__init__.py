"""Plan shapes shared by the operators: ordering, skew handling and scratch tables."""
