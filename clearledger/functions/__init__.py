"""Column expressions: parsing, text clean-up and code sets. All run inside the JVM."""
