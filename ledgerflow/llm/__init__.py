"""Training-data operators: quality, tokens, dedup, decontamination, chat, HTML, language.

Nothing else in the library imports this subpackage.
"""
