"""Small-area housing and market analytics as Spark plans."""
