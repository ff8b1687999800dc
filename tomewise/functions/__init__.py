"""Column expressions. Nothing here triggers a job or needs a shuffle."""
