"""Column expressions; all of them run JVM-side."""
