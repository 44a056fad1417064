"""Column helpers: fiscal calendar, money, text."""
