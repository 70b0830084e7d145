"""Column functions: text measures, JSON fields and stable sampling."""
