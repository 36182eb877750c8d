"""Operators for preparing training text: one module per operator.

Nothing outside this subpackage imports it.  ``aerolake.llm.register`` holds the
registered queries and their SQL.
"""
