"""Training-data operators: language identification, near-duplicate removal,
packing, main-text extraction, decontamination, WARC archives, secret scans,
quality rules, transcript parsing and line deduplication.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
