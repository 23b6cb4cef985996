"""Lazy DataFrame -> DataFrame operators (no collect, no row-at-a-time UDF)."""
