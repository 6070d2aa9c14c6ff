"""Complete loads: stage tables and current targets in, merged tables out."""
