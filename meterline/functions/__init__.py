"""Column functions. Everything here builds Spark expressions; nothing runs Python per row."""
