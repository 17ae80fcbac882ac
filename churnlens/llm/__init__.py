"""Operators for preparing text corpora: language id, decontamination, quality,
HTML extraction, token counting, byte-level BPE and five kinds of de-duplication.

Nothing else in the library imports this subpackage.
"""
