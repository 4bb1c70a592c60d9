"""Column builders: every function takes and returns Columns and stays in the JVM."""
