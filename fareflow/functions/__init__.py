"""Column expressions. All stay inside the JVM; none is a Python UDF."""
