"""Column expressions: parsing, vectors, geometry, bins and scores. All run inside Spark's generated code, but for pixels."""
