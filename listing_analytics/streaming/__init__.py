"""The extraction of new files as they arrive."""
