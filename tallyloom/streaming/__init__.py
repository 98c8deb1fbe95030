"""Micro-batch forms of the batch change operators.

The reference has no streaming operators; late change is handled in batch by
``flag_soft_deletes`` and ``replace_date_window``.  What is here only runs the
same batch operators on each micro-batch of newly landed rows.
"""
