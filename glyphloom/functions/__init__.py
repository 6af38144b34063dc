"""Column functions: JVM-side expressions, one module per kind of value."""
