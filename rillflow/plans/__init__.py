"""Composable DataFrame pipelines and the ingest and publish plans built from them."""
