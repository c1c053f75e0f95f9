"""Whole jobs: ingest, transform, audit, and one date window from captures to clean documents."""
