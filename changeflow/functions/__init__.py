"""Column expressions; each stays inside the JVM."""
