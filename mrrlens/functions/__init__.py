"""Column functions: parsing of raw text, month arithmetic, revenue classes."""
