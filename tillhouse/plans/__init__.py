"""Providers and the steps that take their feeds to silver and gold."""
