"""Reusable DataFrame steps: dedupe, skew-aware joins, consensus, reshape, rubric."""
