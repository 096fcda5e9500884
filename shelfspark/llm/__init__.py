"""Operators for large text corpora; nothing outside this folder imports it.

Rules that hold in every operator here:

* A null text counts as the empty text; a null ``doc_id`` is a document without a number.
* Rows that repeat the same ``doc_id`` and text are one document and share one verdict.
* Only the columns named in a signature are read, so extra columns (whatever
  their names) never clash; stage functions hand them on untouched.
* An empty table gives an empty table with the full schema.
"""
