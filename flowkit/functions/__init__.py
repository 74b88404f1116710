"""Column functions: plain expressions, all evaluated in the JVM."""
