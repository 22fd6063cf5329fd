"""Column expressions used by the audit operators (all JVM-side built-ins)."""
