"""Training-data operators: filters, deduplication, mixing and tokenising of text corpora.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries.py`` registers one thin
``opN_<name>`` query per operator and its SQL where SQL can express it.
"""
