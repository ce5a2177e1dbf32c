"""Column-returning helpers; all of them stay inside the JVM."""
