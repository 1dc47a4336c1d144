"""Silver jobs and gold models."""
