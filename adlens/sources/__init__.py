"""Readers and writers: impression tables, prediction log, A/B store, materialised steps."""
