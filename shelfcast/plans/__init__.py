"""Composed reports: weekly KPI extract, trend push, weather push."""
