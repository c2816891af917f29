"""Column expressions and the small pluggable functions used inside tasks."""
