"""Operators for training-data pipelines over a ``documents`` table.

Nothing outside this folder imports it.  Common rules, unless a docstring says
otherwise: a null text counts as the empty text, rows are never dropped
because of a null key, repeated rows are handled as separate rows, an empty
table gives an empty result of the same schema, and columns other than the
named ones are ignored (so extra columns may have any name).

* ``text``       byte-level tokenising and 64-bit hashing of Arrow text blocks
* ``katz``       Katz back-off n-gram scores
* ``licences``   canonical digest lookup of licence texts (native)
* ``packing``    vector bin packing into fixed-length sequences
* ``jaccard``    n-gram Jaccard self-join and its components
* ``bpe``        heap and linked-list byte-pair token counts
* ``decontam``   template windows against a benchmark (native)
* ``secret_scan`` secret spans with structural confirmation
* ``quality``    factorisation machine over hashed words and structure
* ``sketch``     bottom-k fingerprints
* ``lattice``    integer vectors in bounded blocks
* ``threshold_topk`` exact top-k search with a uniform threshold
* ``hard_negatives`` negatives from lists that clusters of anchors share
* ``periodic``   periodic runs of words
* ``chat``       schema fingerprints, canonical turns, chat template
"""
