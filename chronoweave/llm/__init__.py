"""Operators for large training-text corpora (sharding, privacy, decontamination, quality
rules, URL filters, token counts, HTML extraction, deduplication, joins, packing).

Every operator is a DataFrame -> DataFrame function with its own general interface; the
thin queries that apply them to the tables are in :mod:`chronoweave.llm.queries`."""
