"""Table contracts, readers (A1-A8) and writers."""
