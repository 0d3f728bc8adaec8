"""Operators that prepare text corpora for model training.

Nothing else in the library imports this subpackage.  Every operator takes a
``documents``-shaped DataFrame (``doc_id``, ``text`` and any further columns)
and reads only the columns it names.
"""
