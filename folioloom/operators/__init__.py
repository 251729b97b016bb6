"""Relational operators over lines, blocks, parts, boxes and logs."""
