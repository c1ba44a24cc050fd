"""Column expressions: everything here stays in the JVM and works on any DataFrame."""
