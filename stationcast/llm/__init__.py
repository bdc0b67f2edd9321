"""Corpus operators for training-data preparation: near-duplicate and repeat removal, decontamination, quality,
toxicity and licence scans, tokenisation, language-model scoring and WARC files.

``queries`` registers one query per operator; nothing else in the library imports this subpackage.
"""
