"""Readers and writers for tasks, catalogues, captures and message logs."""
