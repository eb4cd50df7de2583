"""Composed jobs: staging, marts and the analyses, from raw inputs to results."""
