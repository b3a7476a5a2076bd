"""Column expressions: geometry, value buckets, and their SQL registration."""
