"""Column expressions: text, dates and numbers. All built-in functions, no Python UDF."""
