"""Sources: trip files, trip views over tables, and lake tables."""
