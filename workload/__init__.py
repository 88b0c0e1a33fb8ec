"""The library applied to the test tables."""
