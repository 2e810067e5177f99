"""Pure Column expressions: text, numbers, dates, security codes."""
