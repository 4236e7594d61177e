"""Composite jobs: table migration, batches of migrations."""
