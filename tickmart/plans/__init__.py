"""Models (the source project's SQL layers) and the jobs that run them."""
