"""Column-to-column rules; all of them stay inside generated JVM code."""
