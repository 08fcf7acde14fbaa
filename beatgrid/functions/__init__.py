"""Column expressions shared by the operators. All of them run JVM-side."""
