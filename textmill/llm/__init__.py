"""Operators for corpora that language models are trained on.

Each takes a frame with an id column and a text column and returns a new frame
with that id and the operator's own columns, so extra input columns of any name
pass by unread. Nothing else in the package imports this one.
"""
