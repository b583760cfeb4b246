"""Payload readers, flatteners, table loads and freshness gates."""
