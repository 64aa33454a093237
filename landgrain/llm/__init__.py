"""Operators for preparing training text at scale; `catalog` lists their queries."""
