"""Column expressions. All of them run inside the JVM and look at one row only."""
