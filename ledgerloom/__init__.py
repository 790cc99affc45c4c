"""Auditable curation of document collections on Spark."""
