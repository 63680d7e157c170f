"""Column builders. All of them stay in JVM expressions; there are no Python UDFs."""
