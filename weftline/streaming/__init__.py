"""Re-running the pipeline when its input changes."""
