"""Column expressions: calendar, demand factors, staffing and text helpers."""
