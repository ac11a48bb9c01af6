"""adlens: ad-impression analytics as PySpark DataFrame operators and streaming jobs."""
