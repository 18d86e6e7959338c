"""Column-level functions: every one returns a JVM-side ``Column``."""
