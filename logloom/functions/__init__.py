"""Column functions; everything here stays inside JVM expressions."""
