"""Log scans, record parsers and dictionary tables."""
