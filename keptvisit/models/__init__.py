"""Training, scoring and explanation with MLlib."""
