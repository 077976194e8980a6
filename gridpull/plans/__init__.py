"""Job graphs: single-sheet and batch extraction, registered queries."""
