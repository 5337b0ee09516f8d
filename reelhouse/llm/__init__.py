"""Training-data operators: mixing, language id, LM scoring, toxicity, substring
dedup, licence scan, decontamination, quality rules, HTML extraction, Jaccard join,
SimHash join, collocations, spelling variants.

Nothing else in the library imports this package.
"""
