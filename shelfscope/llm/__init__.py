"""Training-data operators: filtering, deduplication, mixing and packing of text corpora.

Each module holds one operator with its own interface; ``queries`` registers the thin
``opN_<name>`` entries. Nothing outside this package imports it.
"""
