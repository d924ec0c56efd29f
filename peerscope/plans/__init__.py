"""Layered models (staging -> intermediate -> marts) and benchmark-table queries."""
