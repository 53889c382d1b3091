"""Stateful stream operators, sinks and replay of tables as streams."""
