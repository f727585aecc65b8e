"""Column functions: every one maps columns to a column, inside the JVM."""
