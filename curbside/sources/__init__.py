"""Dataset contracts, readers, lookups, versioned tables and file layouts."""
