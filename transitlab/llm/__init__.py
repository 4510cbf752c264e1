"""Operators for preparing training data: detection, encoding, de-duplication, packing and formatting."""
