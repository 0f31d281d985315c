"""Reading the landed sources and writing the target tables."""
