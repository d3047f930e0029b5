"""Scalar column expressions; nothing here triggers a job."""
