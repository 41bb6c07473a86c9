"""The four analyses, composed from ``operators`` and ``functions``."""
