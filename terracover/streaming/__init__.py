"""Empty: the pipeline has no streaming operator."""
