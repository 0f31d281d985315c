"""Column expressions: text cleansing, dates, talk time."""
