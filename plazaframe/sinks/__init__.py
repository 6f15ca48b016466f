"""Writing results and tables."""
