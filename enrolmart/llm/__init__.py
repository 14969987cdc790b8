"""Operators for building training corpora, each a function of DataFrames.

Nothing outside this subpackage imports it.  Conventions shared by every
operator:

* a null text is an empty text, a null id is an id of its own (it compares
  equal to itself and sorts after all other ids);
* rows are never dropped, capped or sampled; rows that are equal in id and
  text get equal results;
* only the named columns are read, under internal names, so extra columns
  may have any name.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a worker
# needs the package neither installed nor on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
