"""Operators of a training-data pipeline (token counts, near-dedup, archive
fixity, decontamination, BPE, quality, fingerprints, language id, LM scoring,
binary token output). Nothing else in the library imports this subpackage."""
