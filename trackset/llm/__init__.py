"""Operators for preparing language-model training data.

Nothing outside this folder (and `corpus_pipeline.py`) imports it.  Each operator is one module with its
own general interface; `trackset.llm.queries` holds the thin contract queries `opN_<name>`.
"""
