"""Column-expression helpers.  Everything here builds JVM-side expressions (no Python UDFs)."""
