"""Training-data operators: filters, deduplication, mixing, archives, sharding.

Nothing else in the library imports this subpackage; it can be deleted.  Its Python
functions travel to the executors by value, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
