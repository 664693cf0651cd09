"""Column expressions: all JVM-side except the Student-t helpers."""
