"""Training-data pipeline operators.

Thirteen operators over tables of documents, pages and conversations (line
dedup, token counts, substring dedup, n-gram Jaccard join, quality rules,
benchmark decontamination, packing, quality classifier, secret scans, archive
reading, phrase collocations, document fingerprints, conversation prefix
trie). Of the rest of the package only ``operators.similarity`` imports from
it (``textscan``, ``common``); their registered queries are in ``quillspark.llm.queries``.
"""
