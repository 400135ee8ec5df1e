"""Column expressions: every parser is built from JVM-side functions, none is a Python UDF."""
