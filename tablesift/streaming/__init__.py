"""The same filters on streams."""
