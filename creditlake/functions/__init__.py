"""Column expressions: every function maps Column to Column and stays in the JVM."""
