"""Column expressions: clocks, calendars, labels, messages and casts."""
