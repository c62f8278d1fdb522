"""Operators for preparing training data: scoring, deduplication, decontamination, mixing and output."""
