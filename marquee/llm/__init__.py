"""Operators of a training-data pipeline: tokenising, language ID, near
duplicates, chat formatting, line dedup, quality, decontamination, token files,
URL rules and toxicity.

Nothing outside this subpackage imports it. ``queries`` holds the registered
queries; each operator's module holds its general interface.
"""
