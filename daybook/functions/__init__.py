"""Column functions: every one returns a JVM-side expression."""
