"""Operators for training-data pipelines: mixing, chat formatting, language
ID, token files, toxicity, URL rules, decontamination, near-duplicate joins,
fingerprints and secret scans.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
