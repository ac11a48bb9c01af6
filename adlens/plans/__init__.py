"""Multi-step jobs: feature table, model training, batch scoring, profiling."""
