"""Key files and versioned tables."""
