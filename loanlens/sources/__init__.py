"""Readers for the raw inputs and writers for staged tables and results."""
