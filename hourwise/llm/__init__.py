"""Operators of a large-scale training-data pipeline (language ID, dedup, decontamination, PII, mixing ...)."""
