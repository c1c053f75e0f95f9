"""Column expressions. Everything is native Spark except the Arrow page readers in ``pages``."""
