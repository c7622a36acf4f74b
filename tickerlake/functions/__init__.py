"""Column-level building blocks: exact rounding, label rules, redaction."""
