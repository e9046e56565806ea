"""Scans (``files``, ``tables``) and sinks (``sinks``)."""
