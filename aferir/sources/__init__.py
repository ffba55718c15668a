"""Readers: delimited text, workbooks, cleaned tables, and file discovery."""
