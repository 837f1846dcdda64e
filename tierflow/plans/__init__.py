"""Batch jobs: raw load, promotion, enrichment, star schema and serving."""
