"""Training-data operators: matching, repair, mixing and screening of business records and texts.

Nothing outside this subpackage imports it; it may import the core.
"""
