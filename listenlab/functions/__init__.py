"""Column expressions: text repair, capitalisation, Python-compatible number text."""
