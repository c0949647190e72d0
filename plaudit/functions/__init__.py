"""Column-level building blocks; all of them stay inside generated JVM code."""
