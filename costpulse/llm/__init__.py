"""Operators for preparing training data at scale; nothing else in the library imports them.

One module per operator, each with a general DataFrame interface; ``queries`` derives the
registered query of every operator from it. Shared pieces: ``common`` (reading, lineage cuts,
bounded samples), ``textarrays`` (texts as numpy arrays), ``buckets`` (hash buckets split
into bounded tiles) and ``graph`` (distributed union-find).
"""
