"""quarry: data-mining operators expressed as Spark DataFrame / ML / Structured Streaming plans.

Sub-packages
------------
sources    readers and writers (delimited text, edge and adjacency lists, vectors, communities)
functions  Column-expression helpers (array algebra, tokenising, hashing, statistics)
operators  the operators themselves, one module per area (cleaning, relational, graph, ...)
plans      registered queries over the driver's tables, each paired with an equivalent SQL text
streaming  Structured Streaming lexicon counts
"""

__version__ = "0.1.0"
