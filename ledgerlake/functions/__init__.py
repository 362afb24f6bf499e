"""Column expressions; all of them are built from JVM-side functions."""
