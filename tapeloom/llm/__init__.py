"""Operators for preparing training text at scale; nothing else in tapeloom imports this subpackage."""
