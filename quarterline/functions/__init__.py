"""Column-expression functions (JVM-side built-ins only)."""
