"""Plans: layout check, reconciliation, partition distribution, run report."""
