"""Column expressions: type walking, encoding and decoding."""
