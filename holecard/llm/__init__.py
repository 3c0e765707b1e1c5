"""Training-data operators: language ID, URL filter, substring dedup, exact
top-k search, mixing, chat formatting, packing, quality rules, toxicity and an
n-gram Jaccard join.  Nothing outside this subpackage imports it.
"""
