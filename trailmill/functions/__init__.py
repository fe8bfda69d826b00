"""Column expressions that run inside the JVM."""
