"""End-to-end jobs from input path to output path."""
