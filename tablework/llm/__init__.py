"""Training-data operators: tokenising, cleaning, deduplicating and packing text.

Nothing outside this subpackage imports it.  Conventions shared by all operators:

* an operator takes a DataFrame and returns one; it never changes its input or the
  session's settings;
* input columns it does not use are carried through; an input column with the name
  of an output column (in any case) is replaced by the output;
* a null text counts as the empty text, an empty table gives an empty result, and
  repeated rows each get their own result, unless the operator's docstring says
  otherwise.
"""
