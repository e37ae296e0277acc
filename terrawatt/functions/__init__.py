"""Column-level functions (expressions that stay inside the JVM)."""
