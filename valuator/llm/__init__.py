"""Training-data operators: dedup, language ID, decontamination, fingerprints,
token counts, sharding, packing and main-text extraction.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
