"""lograil: log analytics and corpus processing expressed as Spark plans."""
