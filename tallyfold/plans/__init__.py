"""End-to-end jobs composed of the functions and operators."""
