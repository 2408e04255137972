"""Tests of the subpackage ``tilepulse.llm``."""
