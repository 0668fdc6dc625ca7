"""Composite jobs: operators chained into the end-to-end plans a survey runs."""
