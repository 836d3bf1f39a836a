"""Bindings of the case line list to tables that are stored under other names."""
