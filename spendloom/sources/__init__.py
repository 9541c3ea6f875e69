"""Readers and writers: extracts, gate state, ads reports, audit log, tables."""
