"""DataFrame operators: checks, normalisation, composition, cohorts and two-group statistics."""
