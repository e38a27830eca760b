"""Column-level functions. All of them stay in JVM expressions."""
