"""Structured Streaming runner and stateful processors."""
