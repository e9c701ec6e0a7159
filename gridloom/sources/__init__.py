"""Readers and sinks: nested JSON, report layouts, HTML, paged interfaces, tables and exports."""
