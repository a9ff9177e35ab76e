"""Models (staging, marts) and the pipeline that builds them."""
