"""Layer jobs (bronze -> silver -> gold), publishing, catalog registration and the pipeline."""
