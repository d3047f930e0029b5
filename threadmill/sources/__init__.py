"""Readers and writers of archives, dumps, job lists and results."""
