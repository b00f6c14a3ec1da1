"""Operators of a training-data pipeline: tokens, mixing, near copies, chat, search, languages, URLs, decontamination."""
