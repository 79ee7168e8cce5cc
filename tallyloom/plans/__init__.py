"""End-to-end jobs built from sources, functions and operators."""
