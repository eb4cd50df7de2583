"""The staging of snapshot files as they arrive."""
