"""Writers: the versioned store and the per-member JSON export."""
