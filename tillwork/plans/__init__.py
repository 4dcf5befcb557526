"""The reports: functions from a shop (or frames) to a DataFrame."""
