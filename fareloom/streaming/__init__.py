"""The same layers over streams of arriving files."""
