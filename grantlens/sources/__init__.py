"""Readers and writers: raw files, the clean model, reports."""
