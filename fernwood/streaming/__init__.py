"""Fitted transforms applied to streams."""
