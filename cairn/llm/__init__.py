"""Training-data operators: language id, decontamination, de-duplication, tokenising, quality, PII and WARC.

Nothing outside this subpackage imports it.
"""
