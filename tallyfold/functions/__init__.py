"""Column functions: labels, ranks, rounding, filters and distribution tails."""
