"""End-to-end jobs composed from sources and operators."""
