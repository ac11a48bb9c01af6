"""Column expressions: hashing, time, encodings and rule texts."""
