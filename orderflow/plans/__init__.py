"""The delivery pipeline on its six tables, its test adapter and the query catalogue."""
