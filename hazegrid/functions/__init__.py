"""Column expressions: everything here is evaluated inside the JVM."""
