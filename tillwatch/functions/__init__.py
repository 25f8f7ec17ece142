"""Column expressions; everything here stays in JVM code generation."""
